"""Summaries of the check results. Every input here has one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.functions.labels import (
    category_rank, issue_text, preview, score, score_band, slug, status_count, status_label,
)
from vaultgauge.rules import OUTPUT_NAME
from vaultgauge.settings import Settings


def _counts():
    return [
        F.count(F.lit(1)).alias("checks"),
        status_count("PASS").alias("pass"),
        status_count("FAIL").alias("fail"),
        status_count("ERROR").alias("error"),
        F.lit(0).cast("bigint").alias("warning"),  # reserved
        status_count("INFO").alias("info"),
    ]


def run_totals(results: DataFrame) -> DataFrame:
    kinds = [
        F.countDistinct(F.when(F.col("table_type") == kind, F.col("table_name"))).alias(f"{kind.lower()}_tables")
        for kind in ("HUB", "LINK", "SAT")
    ]
    return results.agg(*_counts(), *kinds).withColumn("dq_score", score(F.col("pass"), F.col("fail")))


def dq_score(results: DataFrame) -> DataFrame:
    points = score(status_count("PASS"), status_count("FAIL"))
    return results.agg(points.alias("dq_score"), score_band(points).alias("band"))


def category_summary(results: DataFrame) -> DataFrame:
    return (
        results.groupBy("category")
        .agg(*_counts())
        .select(
            category_rank(F.col("category")).alias("category_rank"),
            "category", "checks", "pass", "fail", "error",
            score(F.col("pass"), F.col("fail")).alias("score"),
        )
        .orderBy("category_rank")
    )


def score_bands(results: DataFrame) -> DataFrame:
    return category_summary(results).select("category", "score", score_band(F.col("score")).alias("band"))


def table_summary(results: DataFrame) -> DataFrame:
    """Per table; the row count comes from the row-count check, which every table has."""
    row_count = F.max(F.when((F.col("check_id") == "T4") & (F.col("status") == "INFO"), F.col("value")))
    return (
        results.groupBy("table_name")
        .agg(F.coalesce(row_count, F.lit(0)).alias("rows"), *_counts())
        .select(
            "table_name", "rows", "pass", "fail", "error", "info",
            ((F.col("fail") > 0) | (F.col("error") > 0)).alias("has_fail"),
        )
        .orderBy("table_name")
    )


def results_ordered(results: DataFrame) -> DataFrame:
    return results.select(
        category_rank(F.col("category")).alias("category_rank"),
        "seq", "category", "table_name", "check_name", "impact", "status", "value",
        preview(F.col("query_text")).alias("query_preview"),
        status_label(F.col("status"), F.col("value")).alias("status_label"),
    ).orderBy("category_rank", "table_name", "seq")


def status_labels(results: DataFrame) -> DataFrame:
    return results.select("seq", "table_name", "status", status_label(F.col("status"), F.col("value")).alias("label"))


def failures(results: DataFrame) -> DataFrame:
    return (
        results.filter(F.col("status").isin("FAIL", "ERROR"))
        .select(
            category_rank(F.col("category")).alias("category_rank"),
            "seq", "category", "table_name", "check_name", "impact", "status", "value",
            issue_text(F.col("status"), F.col("value")).alias("issue_text"),
            "query_text", "error",
        )
        .orderBy("category_rank", "table_name", "seq")
    )


def _utc(settings: Settings):
    return F.to_utc_timestamp(F.expr(settings.now), F.current_timezone())


def report_header(results: DataFrame, settings: Settings) -> DataFrame:
    label = F.concat_ws(" & ", F.lit(settings.schema_label), F.lit(settings.mart_name or None))
    return results.agg(
        F.lit(settings.title).alias("report_title"),
        label.alias("schema_label"),
        F.date_format(_utc(settings), "yyyy-MM-dd HH:mm:ss").alias("run_time_utc"),
        F.count(F.lit(1)).alias("checks"),
        F.countDistinct("category").alias("categories"),
    )


def summary_json(results: DataFrame, settings: Settings) -> DataFrame:
    """The whole report as one JSON object. Its size is that of the result list, whatever the size of the tables."""
    totals = run_totals(results).select(
        F.lit("totals").alias("part"), F.lit(0).cast("bigint").alias("place"), F.struct("*").alias("totals")
    )
    categories = category_summary(results).select(
        F.lit("categories").alias("part"),
        F.col("category_rank").alias("place"),
        F.struct("category", "checks", "pass", "fail", "error", "score").alias("category"),
    )
    tables = table_summary(results).select(
        F.lit("tables").alias("part"),
        F.lit(0).cast("bigint").alias("place"),
        F.struct(F.col("table_name").alias("table"), "rows", "pass", "fail", "error", "info", "has_fail").alias("table"),
    )
    issues = failures(results).select(
        F.lit("failures").alias("part"),
        F.col("category_rank").alias("place"),
        F.struct("table_name", "seq").alias("tie"),
        F.struct(
            "category",
            F.col("table_name").alias("table"),
            F.col("check_name").alias("check"),
            "value",
            F.col("query_text").alias("sql"),
        ).alias("failure"),
    )
    parts = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [totals, categories, tables, issues]
    )

    def gathered(part, column, *order):
        members = F.collect_list(F.when(F.col("part") == part, F.struct(*order, column)))
        return F.transform(F.array_sort(members), lambda m: m[column])

    document = parts.agg(
        F.max("totals").alias("totals"),
        gathered("categories", "category", "place").alias("categories"),
        gathered("tables", "table").alias("tables"),
        gathered("failures", "failure", "place", "tie").alias("failures"),
    )
    run_time = F.date_format(_utc(settings), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    t = F.col("totals")
    return document.select(
        F.lit(OUTPUT_NAME).alias("name_format"),
        slug(F.lit(settings.database)).alias("slug"),
        F.to_json(
            F.struct(
                F.lit(settings.title).alias("report_title"),
                F.lit(settings.schema_label).alias("schema_label"),
                F.regexp_replace(run_time, "\\.000000$", "").alias("run_ts_utc"),
                t["checks"].alias("total_checks"),
                t["pass"].alias("pass"),
                t["fail"].alias("fail"),
                t["error"].alias("error"),
                t["warning"].alias("warning"),
                t["info"].alias("info"),
                t["dq_score"].alias("dq_score"),
                "categories",
                "tables",
                "failures",
            ),
            {"ignoreNullFields": "false"},
        ).alias("document"),
    ).select(F.replace("name_format", F.lit("{slug}"), F.col("slug")).alias("name"), "document")
