"""Verdict, score, labels, order and the report document, over made results."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vaultgauge.functions import labels
from vaultgauge.plans import summary
from vaultgauge.plans.verdict import with_status

SCHEMA = (
    "seq bigint, category string, table_name string, table_type string, check_id string, check_name string, kind string, "
    "impact string, query_text string, value bigint, error string"
)


def results(spark, *rows):
    """rows: category, table, check, kind, value, error"""
    full = [
        (n, category, table, "HUB", check, f"name {n}", kind, "impact", f"SELECT {n}", value, error)
        for n, (category, table, check, kind, value, error) in enumerate(rows, start=1)
    ]
    return with_status(spark.createDataFrame(full, SCHEMA))


@pytest.fixture(scope="module")
def mixed(spark):
    return results(
        spark,
        ("Volume", "B", "V1", "bool", 1, None),
        ("Technical", "B", "T1", "count", None, None),
        ("Technical", "B", "T2", "count", 4321, None),
        ("Technical", "B", "T4", "info", 1234567, None),
        ("Technical", "A", "T4", "info", None, "boom"),
        ("Freshness", "A", "F3", "info", None, None),
        ("Technical", "A", "T1", "count", 7, None),
    )


def test_status(mixed):
    assert [(r.status, r.value) for r in mixed.orderBy("seq").collect()] == [
        ("FAIL", 1), ("PASS", 0), ("FAIL", 4321), ("INFO", 1234567), ("ERROR", None), ("INFO", 0), ("FAIL", 7),
    ]


def test_totals_and_score(mixed):
    t = summary.run_totals(mixed).first()
    assert (t.checks, t["pass"], t.fail, t.error, t.warning, t.info, t.dq_score) == (7, 1, 3, 1, 0, 2, 25)
    assert tuple(summary.dq_score(mixed).first()) == (25, "red")


@pytest.mark.parametrize(
    "passed, failed, points", [(1, 7, 12), (3, 5, 38), (0, 0, 100), (0, 3, 0), (5, 0, 100), (199, 1, 100), (995, 5, 100), (1, 2, 33)]
)
def test_score_rounds_halves_to_even(spark, passed, failed, points):
    # 12.5 -> 12, 37.5 -> 38, 99.5 -> 100
    row = spark.range(1).select(labels.score(F.lit(passed), F.lit(failed)).alias("s")).first()
    assert row.s == points == (round(passed * 100.0 / (passed + failed)) if passed + failed else 100)


def test_bands(spark):
    df = spark.createDataFrame([(n,) for n in (100, 90, 89, 70, 69, 0)], "n int").select(labels.score_band(F.col("n")))
    assert [r[0] for r in df.collect()] == ["green", "green", "amber", "amber", "red", "red"]


def test_categories_in_fixed_order(mixed):
    rows = [tuple(r) for r in summary.category_summary(mixed).collect()]
    assert rows == [
        (1, "Technical", 5, 1, 2, 1, 33), (2, "Freshness", 1, 0, 0, 0, 100), (3, "Volume", 1, 0, 1, 0, 0),
    ]


def test_tables(mixed):
    rows = [tuple(r) for r in summary.table_summary(mixed).collect()]
    assert rows == [("A", 0, 0, 1, 1, 1, True), ("B", 1234567, 1, 2, 0, 1, True)]


def test_order_and_texts(mixed):
    rows = summary.failures(mixed).collect()
    assert [(r.seq, r.issue_text) for r in rows] == [
        (5, "query issue(s) found"), (7, "7 issue(s) found"), (3, "4,321 issue(s) found"), (1, "1 issue(s) found"),
    ]
    assert rows[0].error == "boom"
    ordered = summary.results_ordered(mixed).collect()
    assert [r.seq for r in ordered] == [5, 7, 2, 3, 4, 6, 1]
    assert [r.status_label for r in ordered] == ["ERROR", "FAIL (7)", "PASS", "FAIL (4,321)", "1,234,567", "0", "FAIL (1)"]


def test_preview(spark):
    texts = ["x" * 64, "x" * 65, "x" * 66]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(labels.preview(F.col("t")))
    assert [r[0] for r in df.collect()] == [texts[0], texts[1], texts[1] + "…"]


def test_slug(spark):
    df = spark.range(1).select(labels.slug(F.lit("Raw.Vault--2_x é")))
    assert df.first()[0] == "raw_vault_2_x_"


def test_document(mixed, settings):
    s = replace(settings, database="Raw.Vault", schema_label="X.Y", as_of="2024-01-30 12:00:00.25")
    row = summary.summary_json(mixed, s).first()
    document = json.loads(row.document)
    assert row.name == "dv_validation_report_raw_vault"
    assert list(document) == [
        "report_title", "schema_label", "run_ts_utc", "total_checks", "pass", "fail", "error", "warning", "info",
        "dq_score", "categories", "tables", "failures",
    ]
    assert (document["report_title"], document["run_ts_utc"], document["warning"]) == ("RAW.VAULT", "2024-01-30T12:00:00.250000", 0)
    assert [c["category"] for c in document["categories"]] == ["Technical", "Freshness", "Volume"]
    assert [t["table"] for t in document["tables"]] == ["A", "B"]
    assert [f["sql"] for f in document["failures"]] == ["SELECT 5", "SELECT 7", "SELECT 3", "SELECT 1"]
    assert document["failures"][0] == {
        "category": "Technical", "table": "A", "check": "name 5", "value": None, "sql": "SELECT 5",
    }


def test_header(mixed, settings):
    s = replace(settings, database="db", report_title="my vault", schema_label="X.Y", mart_name="mart")
    assert tuple(summary.report_header(mixed, s).first()) == ("MY VAULT", "X.Y & mart", "2024-01-30 12:00:00", 7, 3)
    assert summary.report_header(mixed, replace(s, mart_name="", report_title=None)).first()[:2] == ("DB", "X.Y")


def test_nothing_failed(spark, settings):
    df = results(spark, ("Technical", "A", "T4", "info", 1, None))
    document = json.loads(summary.summary_json(df, settings).first().document)
    assert document["failures"] == [] and document["dq_score"] == 100
