"""Titles, categories and kinds of all checks as literals, apart from the engine's registry."""

from dataclasses import replace

from vaultgauge import Vault, validate

# Category, title, kind.
HUB = [
    ("Technical", "NULL hash key (A_HK)", "count"),
    ("Technical", "Duplicate hash key (A_HK)", "count"),
]
LINK = [
    ("Technical", "NULL hub key (A_B_HK)", "count"),
    ("Technical", "NULL hub key (A_HK)", "count"),
    ("Technical", "Orphan records — A_HK not in HUB_A", "count"),
    ("Technical", "Duplicate HK combination", "count"),
]
SAT = [
    ("Technical", "NULL parent hash key (A_HK)", "count"),
    ("Technical", "Duplicate HK + LOAD_DTS", "count"),
    ("Technical", "Orphan records — A_HK not in HUB_A", "count"),
    ("Technical", "NULL hashdiff (HASH_DIFF)", "count"),
    ("Technical", "Duplicate HK + hashdiff", "count"),
]
EVERY = [
    ("Technical", "NULL load date", "count"),
    ("Technical", "Future-dated records", "count"),
    ("Technical", "NULL record source", "count"),
    ("Technical", "Total row count", "info"),
    ("Freshness", "No new records in last 48h (stale pipeline)", "bool"),
    ("Freshness", "Future LOAD_DTS detected (clock skew)", "count"),
    ("Freshness", "Oldest record age (days)", "info"),
    ("Volume", "Zero records loaded today (silent drop)", "bool"),
    ("Volume", "Load spike today vs 7-day avg (>5x)", "bool"),
    ("Volume", "Today's load count", "info"),
    ("Source", "Single source feeding 100% of records", "bool"),
    ("Source", "Distinct record sources count", "info"),
]


def test_every_title(spark, settings):
    audit = "CAST(NULL AS TIMESTAMP) AS load_dts", "'s' AS record_source"
    frames = {
        "hub_a": spark.range(1).selectExpr("'k' AS a_hk", *audit),
        "link_a_b": spark.range(1).selectExpr("'l' AS a_b_hk", "'k' AS a_hk", *audit),
        "sat_a": spark.range(1).selectExpr("'k' AS a_hk", "'d' AS hash_diff", *audit),
    }
    rows = validate(Vault.from_frames(spark, frames), replace(settings)).results.orderBy("seq").collect()
    for table, own in (("HUB_A", HUB), ("LINK_A_B", LINK), ("SAT_A", SAT)):
        assert [(r.category, r.check_name, r.kind) for r in rows if r.table_name == table] == own + EVERY
