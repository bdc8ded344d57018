"""Write a report: the JSON document as text and the data behind it as tables."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.functions.labels import slug
from vaultgauge.functions.storage import exists, folders, remove
from vaultgauge.plans.runner import Report
from vaultgauge.rules import OUTPUT_NAME


def output_name(report: Report) -> str:
    spark = report.results.sparkSession
    return OUTPUT_NAME.format(slug=spark.range(1).select(slug(F.lit(report.settings.database))).first()[0])


def write_document(report: Report, folder: str) -> str:
    """One JSON object under <folder>/<name>.json."""
    path = f"{folder.rstrip('/')}/{output_name(report)}.json"
    report.document().select("document").write.mode("overwrite").text(path)
    return path


TABLES = {
    "check_results": lambda report: report.results,
    "category_summary": Report.categories,
    "table_summary": Report.tables,
    "failures": Report.failures,
    "diagnostics": Report.diagnostics,
}


def write_tables(report: Report, folder: str, file_format: str = "parquet") -> None:
    """check_results, category_summary, table_summary, failures and diagnostics, partitioned by database and date of the run.

    A run replaces what earlier runs wrote for its database and date, also by nothing: written again it changes nothing,
    and other databases and dates stay. A run of some checks or tables replaces the results within its scope only; the
    others of that day stay, with the run_ts at which they were found, and the summaries are those of all of them together.

    The new rows of all five tables are staged first, with a manifest as the last file. Only then are the partitions
    replaced. A writer that is lost before the manifest has changed nothing; what one lost after it has left undone, the
    next write to the folder (or `finish_writes`) does, from the staged rows. One writer per folder at a time.
    """
    spark, folder = report.results.sparkSession, folder.rstrip("/")
    finish_writes(spark, folder)
    partition = f"database={partition_name(report.settings.database)}/run_date={report.settings.as_of[:10]}"
    whole = _with_kept_results(report, f"{folder}/check_results/{partition}", file_format)
    run_ts = F.expr(report.settings.now).alias("run_ts")
    staged = f"{folder}/{STAGED}/{time.time_ns()}-{uuid.uuid4().hex}"  # in the order of the writes
    for name, rows in TABLES.items():
        df = rows(whole)
        df = df if "run_ts" in df.columns else df.select("*", run_ts)
        df.coalesce(1).write.format(file_format).save(f"{staged}/{name}")  # a row per check or less
    manifest = [(partition, file_format, name, rows(whole).schema.json()) for name, rows in TABLES.items()]
    spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.json(f"{staged}/manifest")
    finish_writes(spark, folder)


STAGED = "_staged"
MANIFEST = "partition string, file_format string, table string, schema string"
# Characters that stand as % and two hex digits in the name of a partition's folder.
ESCAPED = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\\x7f{[]^")


def partition_name(value: str) -> str:
    """A value as it stands in the name of a partition's folder."""
    if not value:
        raise ValueError("the database needs a name")
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def finish_writes(spark: SparkSession, folder: str) -> int:
    """Replaces the partitions whose new rows are staged whole, and clears the staging area. Returns how many writes that were.

    Doing it again, or after having been interrupted, gives the same tables.
    """
    folder, done = folder.rstrip("/"), 0
    for run in folders(spark, f"{folder}/{STAGED}"):
        staged = f"{folder}/{STAGED}/{run}"
        manifest = spark.read.schema(MANIFEST).json(f"{staged}/manifest").collect() if exists(spark, f"{staged}/manifest") else []
        if len(manifest) == len(TABLES):
            for r in manifest:
                schema = T.StructType.fromJson(json.loads(r.schema))
                if "run_ts" not in schema.names:
                    schema = schema.add("run_ts", T.TimestampType())
                rows = spark.read.schema(schema).format(r.file_format).load(f"{staged}/{r.table}")
                rows.coalesce(1).write.mode("overwrite").format(r.file_format).save(f"{folder}/{r.table}/{r.partition}")
            done += 1
        remove(spark, staged)
    return done


def _with_kept_results(report: Report, path: str, file_format: str) -> Report:
    """The report, together with what earlier runs of the same day found outside its scope."""
    if report.scope.is_everything or not exists(report.results.sparkSession, path):
        return report
    spark = report.results.sparkSession
    found = report.results.withColumn("run_ts", F.expr(report.settings.now))
    earlier = spark.read.schema(found.schema).format(file_format).load(path).filter(~report.scope.covers())
    # Numbers are those of the whole plan. Where the catalog has changed in between, they are dealt anew, in their order.
    in_order = Window.orderBy("seq", "table_name", "check_name")  # a row per check
    together = earlier.unionByName(found).withColumn("seq", F.row_number().over(in_order).cast("bigint"))
    return Report(together, report.settings, report.catalog, report.scope)


def run_line(report: Report) -> str:
    """The outcome of the run in one line."""
    t = report.totals().first()
    tables = t.hub_tables + t.link_tables + t.sat_tables
    return (
        f"Score {t.dq_score}% | PASS={t['pass']} FAIL={t.fail} ERROR={t.error} INFO={t.info} of {t.checks} checks on "
        f"{tables} tables ({t.hub_tables} HUB / {t.link_tables} LINK / {t.sat_tables} SAT)"
    )
