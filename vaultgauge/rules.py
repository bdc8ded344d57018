"""Naming conventions, thresholds and the registry of the 23 checks."""

from __future__ import annotations

from typing import NamedTuple

# ---- Fixed values: table kinds by name prefix, first match wins ----
PREFIXES = {
    "HUB": ["HUB_", "H_"],
    "LINK": ["LINK_", "L_"],
    "SAT": ["SAT_", "S_"],
}
OTHER = "OTHER"

# ---- Fixed values: hash keys end with this suffix ----
HASH_KEY_SUFFIX = "_HK"

# ---- Fixed values: names of the audit columns in order of priority ----
LOAD_DTS = "LOAD_DTS"
RECORD_SOURCE = "RECORD_SOURCE"
HASH_DIFF = "HASH_DIFF"
SYNONYMS = {
    LOAD_DTS: [
        "LOAD_DTS", "LOAD_DATE", "LOAD_TS", "LOAD_TIMESTAMP", "LOADED_AT", "LOAD_DATETIME",
        "DV_LOAD_DTS", "BATCH_LOAD_DATE", "INSERT_DTS", "ETL_LOAD_DTS", "DWH_LOAD_DATE", "CREATED_DTS",
    ],
    RECORD_SOURCE: [
        "RECORD_SOURCE", "RECORD_SRC", "REC_SRC", "SOURCE_SYSTEM", "DV_RECORD_SOURCE", "SRC_SYSTEM",
        "DATA_SOURCE", "SOURCE_NAME",
    ],
    HASH_DIFF: [
        "HASH_DIFF", "HASHDIFF", "HASH_DIFF_COL", "DV_HASHDIFF", "HDIFF", "ROW_HASH", "HASH_DIFF_VAL",
    ],
}

# ---- Fixed values: where no synonym is present, the first rule all of whose parts occur in a column name ----
FUZZY_RULES = {
    LOAD_DTS: [["LOAD"], ["BATCH"], ["INSERT"], ["CREATED"]],
    RECORD_SOURCE: [["SOURCE"], ["SRC"]],
    HASH_DIFF: [["HASH"], ["DIFF"]],
}

# ---- Fixed values: thresholds ----
STALE_HOURS = 48
SPIKE_MULTIPLIER = 5
SPIKE_WINDOW_DAYS = 8  # days before today that enter the average
SINGLE_SOURCE_PERCENT = 99

# ---- Fixed values: categories in report order, score bands, preview length, output name ----
CATEGORIES = ["Technical", "Freshness", "Volume", "Source"]
SCORE_BANDS = [(90, "green"), (70, "amber")]
LOWEST_BAND = "red"
PREVIEW_CHARS = 65
OUTPUT_NAME = "dv_validation_report_{slug}"
# Fixed value: what becomes an underscore in a slug.
NO_SLUG = "[^a-zA-Z0-9_]+"
NAMES_IN_EMPTY_CATALOG_MESSAGE = 25

# What a check needs to be generated; every need names a column of the catalog (or of its references).
OWN_KEY = "own_hk"
ANY_KEY = "any_hk"
PARENT = "parent_name"


class Check(NamedTuple):
    check_id: str
    table_types: tuple[str, ...]
    per_reference: bool  # once per foreign key of a link
    stage: int  # order within a table; the checks of one stage alternate per foreign key
    category: str
    kind: str  # count, bool: PASS at 0; info: never judged
    needs: tuple[str, ...]
    name: str
    impact: str
    query: str


ANY = ("HUB", "LINK", "SAT")
_NULLS = "SELECT count_if({column} IS NULL) AS value FROM {table}"
_COPIES = (
    "SELECT count_if(copies > 1) AS value FROM "
    "(SELECT count(*) AS copies FROM {table} GROUP BY {columns})"
)
_ORPHANS = (
    "SELECT count(*) AS value FROM {table} AS child "
    "LEFT ANTI JOIN {parent_table} AS parent ON child.{key} = parent.{key}"
)
_FUTURE = "SELECT count_if(CAST({load} AS TIMESTAMP) > TIMESTAMP '{now}') AS value FROM {table}"
_DAYS = "(SELECT to_date(CAST({load} AS TIMESTAMP)) AS day FROM {table})"

# ---- Fixed values: identity, category, kind and title of each check (wording of impact and query is ours) ----
CHECKS = [
    Check("H1", ("HUB",), False, 1, "Technical", "count", (OWN_KEY,),
          "NULL hash key ({own})",
          "Hub rows without a key cannot be joined to any satellite or link.",
          _NULLS.replace("{column}", "{own_sql}")),
    Check("H2", ("HUB",), False, 2, "Technical", "count", (OWN_KEY,),
          "Duplicate hash key ({own})",
          "A key that occurs more than once multiplies rows in every join on it.",
          _COPIES.replace("{columns}", "{own_sql}")),
    Check("L1", ("LINK",), False, 1, "Technical", "count", (OWN_KEY,),
          "NULL hub key ({own})",
          "A relationship without a key of its own cannot carry satellites.",
          _NULLS.replace("{column}", "{own_sql}")),
    Check("L2", ("LINK",), True, 2, "Technical", "count", (),
          "NULL hub key ({key_name})",
          "A relationship with an empty side connects to nothing.",
          _NULLS.replace("{column}", "{key}")),
    Check("L3", ("LINK",), True, 2, "Technical", "count", (PARENT,),
          "Orphan records — {key_name} not in {parent}",
          "Relationships to keys unknown to the parent are lost in inner joins.",
          _ORPHANS),
    Check("L4", ("LINK",), False, 3, "Technical", "count", (ANY_KEY,),
          "Duplicate HK combination",
          "The same relationship stored twice is counted twice.",
          _COPIES.replace("{columns}", "{combo}")),
    Check("S1", ("SAT",), False, 1, "Technical", "count", (OWN_KEY,),
          "NULL parent hash key ({own})",
          "Attributes without a parent key belong to no entity.",
          _NULLS.replace("{column}", "{own_sql}")),
    Check("S2", ("SAT",), False, 2, "Technical", "count", (OWN_KEY, "load_dts_col"),
          "Duplicate HK + LOAD_DTS",
          "Two versions with the same time stamp have no order.",
          _COPIES.replace("{columns}", "{own_sql}, {load}")),
    Check("S3", ("SAT",), False, 3, "Technical", "count", (OWN_KEY, PARENT),
          "Orphan records — {own} not in {parent}",
          "Attributes of keys unknown to the parent never show up in reports.",
          _ORPHANS),
    Check("S4", ("SAT",), False, 4, "Technical", "count", (OWN_KEY, "hash_diff_col"),
          "NULL hashdiff ({diff_name})",
          "Without a row hash every reload looks like a change.",
          _NULLS.replace("{column}", "{diff}")),
    Check("S5", ("SAT",), False, 5, "Technical", "count", (OWN_KEY, "hash_diff_col"),
          "Duplicate HK + hashdiff",
          "An unchanged state was stored again, often by a repeated load.",
          _COPIES.replace("{columns}", "{own_sql}, {diff}")),
    Check("T1", ANY, False, 6, "Technical", "count", ("load_dts_col",),
          "NULL load date",
          "Rows without a load time have no place in the history.",
          _NULLS.replace("{column}", "{load}")),
    Check("T2", ANY, False, 7, "Technical", "count", ("load_dts_col",),
          "Future-dated records",
          "Load times ahead of now point to a wrong zone or clock.",
          _FUTURE),
    Check("T3", ANY, False, 8, "Technical", "count", ("record_source_col",),
          "NULL record source",
          "Rows of unknown origin cannot be traced back.",
          _NULLS.replace("{column}", "{source}")),
    Check("T4", ANY, False, 9, "Technical", "info", (),
          "Total row count",
          "Size of the table.",
          "SELECT count(*) AS value FROM {table}"),
    Check("F1", ANY, False, 10, "Freshness", "bool", ("load_dts_col",),
          "No new records in last {stale_hours}h (stale pipeline)",
          "Nothing arrived for too long; figures from this table are out of date.",
          "SELECT CAST(coalesce(max(CAST({load} AS TIMESTAMP)) < TIMESTAMP '{now}' - make_dt_interval(0, {stale_hours}),"
          " false) AS BIGINT) AS value FROM {table}"),
    Check("F2", ANY, False, 11, "Freshness", "count", ("load_dts_col",),
          "Future LOAD_DTS detected (clock skew)",
          "A loader with a wrong clock spoils every query by time.",
          _FUTURE),
    Check("F3", ANY, False, 12, "Freshness", "info", ("load_dts_col",),
          "Oldest record age (days)",
          "How far the history goes back.",
          "SELECT datediff(DATE '{today}', min(CAST({load} AS TIMESTAMP))) AS value FROM {table}"),
    Check("V1", ANY, False, 13, "Volume", "bool", ("load_dts_col",),
          "Zero records loaded today (silent drop)",
          "Rows came yesterday and none today; the feed may have stopped without an error.",
          "SELECT CAST(count_if(day = DATE '{today}') = 0 AND count_if(day = DATE '{today}' - 1) > 0 AS BIGINT)"
          f" AS value FROM {_DAYS}"),
    Check("V2", ANY, False, 14, "Volume", "bool", ("load_dts_col",),
          "Load spike today vs 7-day avg (>{spike_multiplier}x)",
          "Today's load is more than {spike_multiplier} times the usual; a load may have run twice.",
          "SELECT CAST(coalesce(max(n) FILTER (WHERE day = DATE '{today}') > {spike_multiplier} * avg(n) FILTER "
          "(WHERE day < DATE '{today}'), false) AS BIGINT) AS value FROM (SELECT day, count(*) AS n FROM "
          f"{_DAYS} WHERE day >= DATE '{{today}}' - {{spike_window_days}} GROUP BY day)"),
    Check("V3", ANY, False, 15, "Volume", "info", ("load_dts_col",),
          "Today's load count",
          "Rows that arrived today.",
          f"SELECT count_if(day = DATE '{{today}}') AS value FROM {_DAYS}"),
    Check("R1", ANY, False, 16, "Source", "bool", ("record_source_col",),
          "Single source feeding 100% of records",
          "Nearly all rows have one origin; other feeds may be missing.",
          "SELECT CAST(coalesce(max(n) * 100 >= {single_source_percent} * sum(n), false) AS BIGINT) AS value FROM "
          "(SELECT count(*) AS n FROM {table} GROUP BY {source})"),
    Check("R2", ANY, False, 17, "Source", "info", ("record_source_col",),
          "Distinct record sources count",
          "Number of origins of this table.",
          "SELECT count(DISTINCT {source}) AS value FROM {table}"),
]
CHECK_BY_ID = {c.check_id: c for c in CHECKS}
