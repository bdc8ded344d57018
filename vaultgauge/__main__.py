"""Validate a database and write its report: spark-submit this module, or python -m vaultgauge."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from vaultgauge import Settings, Vault, rules, validate
from vaultgauge.sinks.report import run_line, write_document, write_tables


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vaultgauge", description=__doc__)
    parser.add_argument("--database", required=True, help="database that holds the hubs, links and satellites")
    parser.add_argument("--output", required=True, help="folder for the document and the result tables")
    parser.add_argument("--schema-label", default="", help="label shown in the report; the database if empty")
    parser.add_argument("--report-title", help="title of the report; the database if empty")
    parser.add_argument("--mart-name", default="", help="shown next to the label")
    parser.add_argument("--stale-hours", type=int, default=rules.STALE_HOURS)
    parser.add_argument("--spike-multiplier", type=int, default=rules.SPIKE_MULTIPLIER)
    parser.add_argument("--as-of", help="timestamp taken for now")
    parser.add_argument("--strict-parents", action="store_true", help="only conventional keys make a parent")
    parser.add_argument("--checks", nargs="+", help="ids of the checks to run; all if not given")
    parser.add_argument("--tables", nargs="+", help="tables to check; all if not given")
    parser.add_argument("--lenient-timestamps", action="store_const", const=True, help="text that is no timestamp counts as NULL")
    parser.add_argument("--concurrent-passes", type=int, default=Settings.concurrent_passes)
    parser.add_argument("--broadcast-key-bytes", type=int, default=Settings.broadcast_key_bytes)
    parser.add_argument("--naming-rules", help="JSON file with any of prefixes, synonyms and fuzzy_rules, as in rules.py")
    given = vars(parser.parse_args(arguments))
    database, output = given["database"], given.pop("output")
    checks, tables, naming = (given.pop(name) for name in ("checks", "tables", "naming_rules"))
    if naming:
        with open(naming, encoding="utf-8") as file:
            given |= {k: v for k, v in json.load(file).items() if k in ("prefixes", "synonyms", "fuzzy_rules")}
    given["schema_label"] = given["schema_label"] or database

    spark = SparkSession.builder.appName(f"vaultgauge {database}").getOrCreate()
    report = validate(Vault.from_database(spark, database), Settings(**given), checks, tables)
    write_tables(report, output)
    print(f"Report written to {write_document(report, output)}")
    print(run_line(report))


if __name__ == "__main__":
    main()
