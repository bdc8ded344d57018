"""The same answers in plain SQL for DuckDB, one query per check, from a catalog written down by hand."""

from __future__ import annotations

from typing import NamedTuple

from vaultgauge.rules import CHECK_BY_ID, FUZZY_RULES, SYNONYMS
from vaultgauge.testbed.suite import CHECK_KEYS
from vaultgauge.testbed.vaults import AS_OF, MAIN_VIEWS, QUIRK_VIEWS, duckdb_ctes

NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"DATE '{AS_OF[:10]}'"


class Table(NamedTuple):
    view: str
    kind: str
    columns: str
    own: str | None = None
    load: str | None = None
    source: str | None = None
    diff: str | None = None
    keys: str = ""
    references: tuple[tuple[str, str | None], ...] = ()  # key, view of the parent

    @property
    def name(self) -> str:
        return self.view.upper()


MAIN = [
    Table("hub_customer", "HUB", "CUSTOMER_HK CUSTOMER_BK LOAD_DTS RECORD_SOURCE",
          "CUSTOMER_HK", "LOAD_DTS", "RECORD_SOURCE", None, "CUSTOMER_HK"),
    Table("hub_order", "HUB", "ORDER_HK ORDER_BK LOAD_DATE REC_SRC",
          "ORDER_HK", "LOAD_DATE", "REC_SRC", None, "ORDER_HK"),
    Table("hub_user", "HUB", "USER_HK USER_BK BATCH_TS SRC_NAME",
          "USER_HK", "BATCH_TS", "SRC_NAME", None, "USER_HK"),
    Table("link_customer_order", "LINK", "CUSTOMER_ORDER_HK CUSTOMER_HK ORDER_HK LOAD_DTS RECORD_SOURCE",
          "CUSTOMER_ORDER_HK", "LOAD_DTS", "RECORD_SOURCE", None, "CUSTOMER_ORDER_HK, CUSTOMER_HK, ORDER_HK",
          (("CUSTOMER_HK", "hub_customer"), ("ORDER_HK", "hub_order"))),
    Table("sat_customer", "SAT", "CUSTOMER_HK C_NAME C_MKTSEGMENT LOAD_DTS HASH_DIFF RECORD_SOURCE",
          "CUSTOMER_HK", "LOAD_DTS", "RECORD_SOURCE", "HASH_DIFF", "CUSTOMER_HK", (("CUSTOMER_HK", "hub_customer"),)),
    Table("sat_user", "SAT", "USER_HK EVENT_TYPE VALUE LOAD_TIMESTAMP HASHDIFF SOURCE_SYSTEM",
          "USER_HK", "LOAD_TIMESTAMP", "SOURCE_SYSTEM", "HASHDIFF", "USER_HK", (("USER_HK", "hub_user"),)),
    Table("s_user_daily", "SAT", "USER_HK LOADED_AT ROW_HASH DATA_SOURCE",
          "USER_HK", "LOADED_AT", "DATA_SOURCE", "ROW_HASH", "USER_HK", (("USER_HK", "hub_user"),)),
    Table("sat_empty", "SAT", "ORDER_HK LOAD_DTS HASH_DIFF RECORD_SOURCE",
          "ORDER_HK", "LOAD_DTS", "RECORD_SOURCE", "HASH_DIFF", "ORDER_HK", (("ORDER_HK", "hub_order"),)),
    Table("orders_raw", "OTHER", "O_ORDERKEY O_ORDERDATE"),
]
QUIRK = [
    Table("h_order", "HUB", "ORDER_HK", "ORDER_HK", None, None, None, "ORDER_HK"),
    Table("l_order_part", "LINK", "ORDER_HK PART_HK", "ORDER_HK", None, None, None, "ORDER_HK, PART_HK",
          (("PART_HK", None),)),
    Table("s_order", "SAT", "ORDER_HK PAYLOAD_HASH PAYLOAD_AT",
          "ORDER_HK", "PAYLOAD_HASH", None, "PAYLOAD_HASH", "ORDER_HK", (("ORDER_HK", "l_order_part"),)),
]
VAULTS = {"main": (MAIN, MAIN_VIEWS), "quirk": (QUIRK, QUIRK_VIEWS)}


# ---- one query per check ----

def _nulls(t: Table, column: str) -> str:
    return f"SELECT count(*) FROM {t.view} WHERE {column} IS NULL"


def _copies(t: Table, columns: str) -> str:
    return f"SELECT count(*) FROM (SELECT {columns} FROM {t.view} GROUP BY {columns} HAVING count(*) > 1)"


def _orphans(t: Table, key: str, parent: str) -> str:
    return f"SELECT count(*) FROM {t.view} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"


def _on(t: Table, days_ago: int) -> str:
    return f"(SELECT count(*) FROM {t.view} WHERE CAST({t.load} AS DATE) = {TODAY} - {days_ago})"


def _value(t: Table, check_id: str, key: str | None, parent: str | None) -> str:
    if check_id in ("H1", "L1", "S1"):
        return _nulls(t, t.own)
    if check_id == "H2":
        return _copies(t, t.own)
    if check_id == "L2":
        return _nulls(t, key)
    if check_id in ("L3", "S3"):
        return _orphans(t, key, parent)
    if check_id == "L4":
        return _copies(t, t.keys)
    if check_id == "S2":
        return _copies(t, f"{t.own}, {t.load}")
    if check_id == "S4":
        return _nulls(t, t.diff)
    if check_id == "S5":
        return _copies(t, f"{t.own}, {t.diff}")
    if check_id == "T1":
        return _nulls(t, t.load)
    if check_id in ("T2", "F2"):
        return f"SELECT count(*) FROM {t.view} WHERE {t.load} > {NOW}"
    if check_id == "T3":
        return _nulls(t, t.source)
    if check_id == "T4":
        return f"SELECT count(*) FROM {t.view}"
    if check_id == "F1":
        return f"SELECT CASE WHEN max({t.load}) < {NOW} - INTERVAL 48 HOURS THEN 1 ELSE 0 END FROM {t.view}"
    if check_id == "F3":
        return f"SELECT date_diff('day', CAST(min({t.load}) AS DATE), {TODAY}) FROM {t.view}"
    if check_id == "V1":
        return f"SELECT CASE WHEN {_on(t, 0)} = 0 AND {_on(t, 1)} > 0 THEN 1 ELSE 0 END"
    if check_id == "V2":
        history = (
            f"SELECT avg(n) FROM (SELECT count(*) AS n FROM {t.view} WHERE CAST({t.load} AS DATE) "
            f"BETWEEN {TODAY} - 8 AND {TODAY} - 1 GROUP BY CAST({t.load} AS DATE))"
        )
        return f"SELECT CASE WHEN {_on(t, 0)} > 5 * ({history}) THEN 1 ELSE 0 END"
    if check_id == "V3":
        return f"SELECT {_on(t, 0)}"
    if check_id == "R1":
        return (
            f"SELECT CASE WHEN max(pct) >= 99 THEN 1 ELSE 0 END FROM "
            f"(SELECT count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM {t.view} GROUP BY {t.source})"
        )
    if check_id == "R2":
        return f"SELECT count(DISTINCT {t.source}) FROM {t.view}"
    raise KeyError(check_id)


def _generated(tables: list[Table]) -> list[tuple[Table, str, str | None, str | None]]:
    """table, check, key and parent in the order of generation."""
    found = []
    for t in tables:
        if t.kind == "OTHER":
            continue
        if t.kind == "HUB":
            found += [(t, "H1", None, None), (t, "H2", None, None)]
        elif t.kind == "LINK":
            found.append((t, "L1", None, None))
            for key, parent in t.references:
                found.append((t, "L2", key, None))
                if parent:
                    found.append((t, "L3", key, parent))
            found.append((t, "L4", None, None))
        else:
            found.append((t, "S1", None, None))
            if t.load:
                found.append((t, "S2", None, None))
            found += [(t, "S3", key, parent) for key, parent in t.references]
            if t.diff:
                found += [(t, "S4", None, None), (t, "S5", None, None)]
        clock, source = t.load, t.source
        found += [(t, c, None, None) for c in ("T1", "T2") if clock]
        found += [(t, "T3", None, None)] if source else []
        found.append((t, "T4", None, None))
        found += [(t, c, None, None) for c in ("F1", "F2", "F3", "V1", "V2", "V3") if clock]
        found += [(t, c, None, None) for c in ("R1", "R2") if source]
    return found


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def _filled(text: str, t: Table, key: str | None, parent: str | None) -> str:
    own_or = {"own": t.own, "own_sql": t.own, "key_name": key, "key": key, "diff_name": t.diff, "diff": t.diff}
    parts = {
        **own_or,
        "parent": parent and parent.upper(),
        "parent_table": parent,
        "table": t.view,
        "load": t.load,
        "source": t.source,
        "combo": t.keys,
        "stale_hours": 48,
        "spike_multiplier": 5,
        "spike_window_days": 8,
        "single_source_percent": 99,
        "now": AS_OF,
        "today": AS_OF[:10],
    }
    for name, value in parts.items():
        text = text.replace("{" + name + "}", str(value))
    return text


def _results(vault: str) -> str:
    """WITH clause up to `results`: one row per check with its verdict."""
    tables, views = VAULTS[vault]
    rows = []
    for seq, (t, check_id, key, parent) in enumerate(_generated(tables), start=1):
        check = CHECK_BY_ID[check_id]
        value, error = f"({_value(t, check_id, key, parent)})", _text(None)
        if t.view == "s_order" and check_id in ("T2", "F1", "F2", "F3", "V1", "V2", "V3"):
            bad = f"(SELECT count(*) FROM {t.view} WHERE {t.load} IS NOT NULL AND TRY_CAST({t.load} AS TIMESTAMP) IS NULL)"
            value = "NULL"
            error = f"'CAST_INVALID_INPUT: ' || {bad} || ' value(s) of column {t.load} cannot be read as a timestamp'"
        rows.append(
            f"SELECT CAST({seq} AS BIGINT) AS seq, {_text(check.category)} AS category, {_text(t.name)} AS table_name, "
            f"{_text(t.kind)} AS table_type, {_text(check_id)} AS check_id, "
            f"{_text(_filled(check.name, t, key or t.own, parent))} AS check_name, {_text(check.kind)} AS kind, "
            f"{_text(_filled(check.impact, t, key, parent))} AS impact, "
            f"{_text(_filled(check.query, t, key or t.own, parent))} AS query_text, "
            f"CAST({value} AS BIGINT) AS raw_value, {error} AS error"
        )
    body = "\nUNION ALL ".join(rows)
    return f"""{duckdb_ctes(views)},
measured AS ({body}),
results AS (
  SELECT * EXCLUDE (raw_value),
         CASE WHEN error IS NULL THEN coalesce(raw_value, 0) END AS value,
         CASE WHEN error IS NOT NULL THEN 'ERROR' WHEN kind = 'info' THEN 'INFO'
              WHEN coalesce(raw_value, 0) <> 0 THEN 'FAIL' ELSE 'PASS' END AS status,
         CASE category WHEN 'Technical' THEN 1 WHEN 'Freshness' THEN 2 WHEN 'Volume' THEN 3 ELSE 4 END::BIGINT
           AS category_rank
  FROM measured)
"""


def _check(*check_ids: str) -> str:
    rows = [
        f"SELECT {_text(t.name)} AS table_name, {_text(c + ':' + key if c in ('L2', 'L3') else c)} AS slot, "
        f"CAST(coalesce(({_value(t, c, key, parent)}), 0) AS BIGINT) AS value"
        for t, c, key, parent in _generated(MAIN)
        if c in check_ids
    ]
    return f"{duckdb_ctes(MAIN_VIEWS)}\n" + "\nUNION ALL ".join(rows)


# ---- catalog: the naming rules over the column lists ----

def _catalog(select: str) -> str:
    ctes, columns, counts = [], [], []
    for vault, (tables, views) in VAULTS.items():
        ctes.append(duckdb_ctes(views).removeprefix("WITH "))
        for position, t in enumerate(tables):
            columns += [
                f"('{vault}', {position}, '{t.name}', {n}, '{c}')" for n, c in enumerate(t.columns.split())
            ]
            counts.append(f"SELECT '{vault}' AS vault, '{t.name}' AS table_name, count(*) AS row_count FROM {t.view}")
    synonyms = ", ".join(f"('{l}', {p}, '{s}')" for l, names in SYNONYMS.items() for p, s in enumerate(names))
    fuzzy = ", ".join(f"('{l}', {n}, '{rule[0]}')" for l, rules in FUZZY_RULES.items() for n, rule in enumerate(rules))
    return f"""WITH {", ".join(ctes)},
columns(vault, position, table_name, ordinal, column_name) AS (VALUES {", ".join(columns)}),
row_counts AS ({" UNION ALL ".join(counts)}),
tables AS (
  SELECT DISTINCT vault, position, table_name,
    CASE WHEN regexp_matches(table_name, '^(HUB|H)_') THEN 'HUB' WHEN regexp_matches(table_name, '^(LINK|L)_') THEN 'LINK'
         WHEN regexp_matches(table_name, '^(SAT|S)_') THEN 'SAT' ELSE 'OTHER' END AS table_type
  FROM columns),
vault_tables AS (SELECT * FROM tables WHERE table_type <> 'OTHER'),
synonyms(logical_name, priority, synonym) AS (VALUES {synonyms}),
fuzzy(logical_name, rule_no, part) AS (VALUES {fuzzy}),
logical AS (SELECT DISTINCT logical_name FROM synonyms),
exact AS (
  SELECT vault, table_name, logical_name, min_by(column_name, priority) AS column_name
  FROM columns JOIN synonyms ON column_name = synonym GROUP BY ALL),
loose AS (
  SELECT vault, table_name, logical_name, min_by(column_name, rule_no * 1000 + ordinal) AS column_name
  FROM columns JOIN fuzzy ON contains(column_name, part) GROUP BY ALL),
audit AS (
  SELECT t.vault, t.table_name, l.logical_name, e.column_name AS exact_name,
         coalesce(e.column_name, f.column_name) AS column_name
  FROM vault_tables t CROSS JOIN logical l
  LEFT JOIN exact e ON e.vault = t.vault AND e.table_name = t.table_name AND e.logical_name = l.logical_name
  LEFT JOIN loose f ON f.vault = t.vault AND f.table_name = t.table_name AND f.logical_name = l.logical_name),
keys AS (
  SELECT c.vault, c.table_name, column_name AS key_column,
         CAST(row_number() OVER (PARTITION BY c.vault, c.table_name ORDER BY ordinal) - 1 AS INTEGER) AS key_no
  FROM columns c JOIN vault_tables t ON t.vault = c.vault AND t.table_name = c.table_name
  WHERE column_name LIKE '%\\_HK' ESCAPE '\\'),
owned AS (
  SELECT t.*, coalesce(
    (SELECT key_column FROM keys k WHERE k.vault = t.vault AND k.table_name = t.table_name
       AND key_column = regexp_replace(t.table_name, '^(HUB|H|LINK|L|SAT|S)_', '') || '_HK'),
    (SELECT key_column FROM keys k WHERE k.vault = t.vault AND k.table_name = t.table_name AND key_no = 0)) AS own_hk
  FROM vault_tables t),
owners AS (
  SELECT vault, own_hk, max_by(table_name, (CASE table_type WHEN 'LINK' THEN 1 ELSE 0 END) * 1000 + position) AS parent_name
  FROM owned WHERE table_type IN ('HUB', 'LINK') GROUP BY ALL),
refs AS (
  SELECT o.vault, o.table_name, k.key_column, p.parent_name,
         CAST(row_number() OVER (PARTITION BY o.vault, o.table_name ORDER BY key_no) - 1 AS INTEGER) AS reference_no
  FROM owned o JOIN keys k ON k.vault = o.vault AND k.table_name = o.table_name
    AND (o.table_type = 'LINK' AND k.key_column <> o.own_hk OR o.table_type = 'SAT' AND k.key_column = o.own_hk)
  LEFT JOIN owners p ON p.vault = o.vault AND p.own_hk = k.key_column)
{select}"""


def _with_row_count(columns: str, relation: str) -> str:
    return _catalog(f"SELECT {columns}, row_count FROM {relation} JOIN row_counts USING (vault, table_name)")


def _check_specs() -> str:
    rows = []
    for vault, (tables, _) in VAULTS.items():
        number: dict[str, int] = {}
        for t, check_id, key, parent in _generated(tables):
            number[t.name] = number.get(t.name, 0) + 1
            check = CHECK_BY_ID[check_id]
            rows.append(
                f"('{vault}', '{t.name}', '{t.kind}', '{check.category}', '{check_id}', "
                f"{_text(_filled(check.name, t, key, parent))}, '{check.kind}', {number[t.name]})"
            )
    return _catalog(
        "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS specs(vault, table_name, table_type, category, check_id, "
        "check_name, kind, check_no) JOIN row_counts USING (vault, table_name)"
    )


# ---- summaries ----

STATUS_COUNTS = """count(*) FILTER (WHERE status = 'PASS') AS pass,
  count(*) FILTER (WHERE status = 'FAIL') AS fail,
  count(*) FILTER (WHERE status = 'ERROR') AS error"""
INFO_COUNT = "count(*) FILTER (WHERE status = 'INFO') AS info"
SCORE = """CAST(coalesce(round_even(100.0::DOUBLE * count(*) FILTER (WHERE status = 'PASS')
  / nullif(count(*) FILTER (WHERE status IN ('PASS', 'FAIL')), 0), 0), 100) AS BIGINT)"""
BAND = "CASE WHEN {0} >= 90 THEN 'green' WHEN {0} >= 70 THEN 'amber' ELSE 'red' END"
THOUSANDS = "format('{:,}', value)"
LABEL = f"CASE status WHEN 'FAIL' THEN 'FAIL (' || {THOUSANDS} || ')' WHEN 'INFO' THEN {THOUSANDS} ELSE status END"
CATEGORIES = f"SELECT category_rank, category, count(*) AS checks, {STATUS_COUNTS}, {SCORE} AS score FROM results GROUP BY ALL"
TABLES = f"""SELECT table_name, coalesce(max(value) FILTER (WHERE check_id = 'T4' AND status = 'INFO'), 0) AS rows,
  {STATUS_COUNTS}, {INFO_COUNT}, count(*) FILTER (WHERE status IN ('FAIL', 'ERROR')) > 0 AS has_fail
  FROM results GROUP BY ALL"""
DOCUMENT = f"""SELECT 'dv_validation_report_main_vault_1' AS name, CAST(to_json(struct_pack(
  report_title := 'MAIN-VAULT 1', schema_label := 'MAIN.VAULT', run_ts_utc := '{AS_OF.replace(" ", "T")}',
  total_checks := count(*), "pass" := count(*) FILTER (WHERE status = 'PASS'),
  "fail" := count(*) FILTER (WHERE status = 'FAIL'), "error" := count(*) FILTER (WHERE status = 'ERROR'),
  "warning" := 0, "info" := count(*) FILTER (WHERE status = 'INFO'), dq_score := {SCORE},
  categories := (SELECT list(struct_pack(category := category, checks := checks, "pass" := pass, "fail" := fail,
    "error" := error, score := score) ORDER BY category_rank) FROM ({CATEGORIES})),
  tables := (SELECT list(struct_pack("table" := table_name, "rows" := rows, "pass" := pass, "fail" := fail,
    "error" := error, info := info, has_fail := has_fail) ORDER BY table_name) FROM ({TABLES})),
  failures := (SELECT list(struct_pack(category := category, "table" := table_name, "check" := check_name,
    value := value, sql := query_text) ORDER BY category_rank, table_name, seq)
    FROM results WHERE status IN ('FAIL', 'ERROR')))) AS VARCHAR) AS document FROM results"""


def oracle_sql() -> dict[str, str]:
    audit = "audit"
    missing = "(SELECT string_agg(logical_name, ',' ORDER BY CASE logical_name WHEN 'LOAD_DTS' THEN 1 WHEN 'RECORD_SOURCE' THEN 2 ELSE 3 END) FROM audit a WHERE a.vault = t.vault AND a.table_name = t.table_name AND a.column_name IS NULL)"

    def audit_of(logical):
        return f"(SELECT column_name FROM audit a WHERE a.vault = t.vault AND a.table_name = t.table_name AND logical_name = '{logical}')"

    found = {
        "catalog_columns": _with_row_count("vault, table_name, ordinal, column_name", "columns"),
        "catalog_classify": _with_row_count("vault, table_name, table_type", "tables"),
        "catalog_resolve_exact": _with_row_count("vault, table_name, logical_name, exact_name AS column_name", audit),
        "catalog_resolve_columns": _with_row_count("vault, table_name, logical_name, column_name", audit),
        "catalog_hash_keys": _with_row_count("vault, table_name, key_no, key_column", "keys"),
        "catalog_own_hk": _with_row_count("vault, table_name, table_type, own_hk", "owned"),
        "catalog_parents": _with_row_count("vault, table_name, reference_no, key_column, parent_name", "refs"),
        "catalog_diagnostics": _with_row_count(
            f"vault, table_name, table_type, {audit_of('LOAD_DTS')} AS load_dts_col, "
            f"{audit_of('RECORD_SOURCE')} AS record_source_col, {audit_of('HASH_DIFF')} AS hash_diff_col, "
            "(SELECT string_agg(key_column, ',' ORDER BY key_no) FROM keys k WHERE k.vault = t.vault "
            f"AND k.table_name = t.table_name) AS hk_columns, coalesce({missing}, '') AS missing",
            "vault_tables t",
        ),
        "catalog_kind_counts": _catalog(
            "SELECT vault, table_type, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS row_count "
            "FROM vault_tables JOIN row_counts USING (vault, table_name) GROUP BY ALL"
        ),
        "check_specs": _check_specs(),
    }
    for check_id, key in CHECK_KEYS.items():
        found[key] = _check(check_id)
        if check_id in ("L3", "S3"):
            found[key + "_shared"] = found[key]
        if check_id in ("H2", "L4", "S2", "S5"):
            found[key + "_hash_first"] = found[key]
    found["sat_duplicates_one_scan"] = _check("S2", "S5")
    over_results = {
        "check_values": "SELECT seq, table_name, check_id, value FROM results",
        "check_results": "SELECT * EXCLUDE (category_rank) FROM results",
        "check_results_shared": "SELECT seq, table_name, check_id, value, status FROM results",
        "check_results_bucketed": "SELECT table_name, check_name, value, status FROM results",
        "check_results_incremental": "SELECT table_name, check_name, value, status FROM results",
        "dq_score": f"SELECT {SCORE} AS dq_score, {BAND.format(SCORE)} AS band FROM results",
        "run_totals": f"SELECT count(*) AS checks, {STATUS_COUNTS}, CAST(0 AS BIGINT) AS warning, {INFO_COUNT}, "
        + ", ".join(
            f"count(DISTINCT table_name) FILTER (WHERE table_type = '{k}') AS {k.lower()}_tables"
            for k in ("HUB", "LINK", "SAT")
        )
        + f", {SCORE} AS dq_score FROM results",
        "category_summary": CATEGORIES,
        "table_summary": TABLES,
        "failures": "SELECT category_rank, seq, category, table_name, check_name, impact, status, value, "
        f"CASE status WHEN 'FAIL' THEN {THOUSANDS} ELSE 'query' END || ' issue(s) found' AS issue_text, query_text "
        "FROM results WHERE status IN ('FAIL', 'ERROR')",
        "results_ordered": "SELECT category_rank, seq, category, table_name, check_name, impact, status, value, "
        "CASE WHEN length(query_text) > 65 THEN query_text[1:65] || '…' ELSE query_text END AS query_preview, "
        f"{LABEL} AS status_label FROM results",
        "score_bands": f"SELECT category, score, {BAND.format('score')} AS band FROM ({CATEGORIES})",
        "status_labels": f"SELECT seq, table_name, status, {LABEL} AS label FROM results",
        "report_header": f"SELECT 'MAIN-VAULT 1' AS report_title, 'MAIN.VAULT' AS schema_label, '{AS_OF}' AS run_time_utc, "
        "count(*) AS checks, count(DISTINCT category) AS categories FROM results",
        "summary_json": DOCUMENT,
    }
    found.update({key: _results("main") + sql for key, sql in over_results.items()})
    found["check_errors"] = _results("quirk") + "SELECT seq, table_name, check_id, value, status, error FROM results"
    return found
