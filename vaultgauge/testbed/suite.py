"""The registered queries: every operator of the engine over the fixture vaults.

Naming rules alone would read a fixed handful of names, so each catalog query carries the row count of the tables it
is about, counted in the same query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultgauge.functions import naming
from vaultgauge.functions.sqltext import literal
from vaultgauge.functions.storage import remove
from vaultgauge.plans import catalog as catalog_plan
from vaultgauge.plans import summary
from vaultgauge.plans.passes import checks_of, grain_frame, make_plan
from vaultgauge.plans.runner import Report, validate
from vaultgauge.plans.specs import check_specs
from vaultgauge.settings import Settings
from vaultgauge.sources.vault import Vault
from vaultgauge.testbed import vaults

Query = Callable[[SparkSession, str], DataFrame]
VAULTS = {"main": vaults.main_vault, "quirk": vaults.quirk_vault}

CHECK_KEYS = {
    "H1": "hub_null_hk",
    "H2": "hub_dup_hk",
    "L1": "link_null_own_hk",
    "L2": "link_null_fk",
    "L3": "link_orphan",
    "L4": "link_dup_combo",
    "S1": "sat_null_hk",
    "S2": "sat_dup_hk_load",
    "S3": "sat_orphan",
    "S4": "sat_null_hashdiff",
    "S5": "sat_dup_hk_hashdiff",
    "T1": "null_load_dts",
    "T2": "future_dated",
    "T3": "null_record_source",
    "T4": "row_count",
    "F1": "stale_pipeline",
    "F2": "future_skew",
    "F3": "oldest_age_days",
    "V1": "zero_today",
    "V2": "load_spike",
    "V3": "today_count",
    "R1": "single_source",
    "R2": "distinct_sources",
}


# ---- catalog ----

def _row_counts(vault: Vault) -> DataFrame:
    counts = [
        vault.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name.upper()).alias("table_name"), "row_count")
        for name in vault.names
    ]
    return reduce(DataFrame.unionAll, counts)


def _over_both_vaults(what: Callable[[Vault, Settings], DataFrame]) -> Query:
    """The metadata of both vaults, with the row count of each table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        settings = vaults.settings().resolved(spark)
        parts = []
        for name, open_vault in VAULTS.items():
            vault = open_vault(spark, sf_dir)
            # A row of counts per table, as many as the catalog has.
            parts.append(
                what(vault, settings).join(F.broadcast(_row_counts(vault)), "table_name").withColumn("vault", F.lit(name))
            )
        return reduce(DataFrame.unionByName, parts)

    return query


def _columns(vault: Vault, settings: Settings) -> DataFrame:
    return catalog_plan.all_columns(vault)


def _classify(vault: Vault, settings: Settings) -> DataFrame:
    return catalog_plan.classified(vault.listing(), settings).select("table_name", "table_type")


def _resolved(expression: Callable[[str, Settings], str]) -> Callable[[Vault, Settings], DataFrame]:
    def resolve(vault: Vault, settings: Settings) -> DataFrame:
        logical = ", ".join(f"{literal(n)}, {expression(n, settings)}" for n in settings.synonyms)
        return catalog_plan.catalog(vault, settings).selectExpr(
            "table_name", f"stack({len(settings.synonyms)}, {logical}) AS (logical_name, column_name)"
        )

    return resolve


def _hash_keys(vault: Vault, settings: Settings) -> DataFrame:
    return catalog_plan.catalog(vault, settings).selectExpr("table_name", "posexplode(hk_columns) AS (key_no, key_column)")


def _own_key(vault: Vault, settings: Settings) -> DataFrame:
    return catalog_plan.catalog(vault, settings).select("table_name", "table_type", "own_hk")


def _parents(vault: Vault, settings: Settings) -> DataFrame:
    tables = catalog_plan.catalog(vault, settings)
    return catalog_plan.references(tables, settings)


def _diagnostics(vault: Vault, settings: Settings) -> DataFrame:
    return catalog_plan.diagnostics(catalog_plan.catalog(vault, settings)).withColumns(
        {"hk_columns": F.array_join("hk_columns", ","), "missing": F.array_join("missing", ",")}
    )


def _check_specs(vault: Vault, settings: Settings) -> DataFrame:
    return check_specs(catalog_plan.catalog(vault, settings), settings).selectExpr(
        "table_name", "table_type", "category", "check_id", "check_name", "kind",
        "row_number() OVER (PARTITION BY table_name ORDER BY generation_order) AS check_no",
    )


def catalog_kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _over_both_vaults(_own_key)(spark, sf_dir)
        .groupBy("vault", "table_type")
        .agg(F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count"))
    )


# ---- checks ----

def _check(check_id: str, shared: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = checks_of(vaults.main_vault(spark, sf_dir), vaults.settings(), [check_id], shared)
        return found.select("table_name", "slot", "value")

    return query


def _hash_first(check_id: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        vault = vaults.main_vault(spark, sf_dir)
        settings = vaults.settings().resolved(spark)
        plan = make_plan(vault, settings)
        frames = [
            grain_frame(vault, plan.targets[s.table_name], [s.slot], settings, hash_first=True)
            for s in plan.specs
            if s.check_id == check_id
        ]
        return reduce(DataFrame.unionAll, frames).select("table_name", "slot", "value")

    return query


def sat_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both duplicate checks of each satellite from one scan of it."""
    return checks_of(vaults.main_vault(spark, sf_dir), vaults.settings(), ["S2", "S5"]).select("table_name", "slot", "value")


# ---- runs ----

def report(spark: SparkSession, sf_dir: str, vault: str = "main", **changes) -> Report:
    return validate(VAULTS[vault](spark, sf_dir), vaults.settings(**changes))


def check_results_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run over tables bucketed by their keys, with the plans of large parents."""
    with vaults.bucketed_main_vault(spark, sf_dir) as vault:
        results = validate(vault, vaults.settings(broadcast_key_bytes=0)).results  # rows of the driver: the tables may go
    return results.select("table_name", "check_name", "value", "status")


def check_results_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run over an unchanged vault: checks of rows come from the partial results that the first one kept."""
    with vaults.bucketed_main_vault(spark, sf_dir) as vault:
        folder = f"{spark.catalog.getDatabase(vault.qualifier[0]).locationUri}/_partials"
        settings = vaults.settings(partials_folder=folder)
        validate(vault, settings)
        results = validate(Vault.from_database(spark, vault.qualifier), settings).results
        remove(spark, folder)
    return results.select("table_name", "check_name", "value", "status")


def _over_report(what: Callable[[Report], DataFrame], **changes) -> Query:
    return lambda spark, sf_dir: what(report(spark, sf_dir, **changes))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "catalog_columns": _over_both_vaults(_columns),
        "catalog_classify": _over_both_vaults(_classify),
        "catalog_resolve_exact": _over_both_vaults(
            _resolved(lambda n, s: naming.by_synonym("columns", s.synonyms[n]))
        ),
        "catalog_resolve_columns": _over_both_vaults(_resolved(lambda n, s: catalog_plan.AUDIT_COLUMNS[n])),
        "catalog_hash_keys": _over_both_vaults(_hash_keys),
        "catalog_own_hk": _over_both_vaults(_own_key),
        "catalog_parents": _over_both_vaults(_parents),
        "catalog_diagnostics": _over_both_vaults(_diagnostics),
        "catalog_kind_counts": catalog_kind_counts,
        "check_specs": _over_both_vaults(_check_specs),
    }
    found.update({key: _check(check_id) for check_id, key in CHECK_KEYS.items()})
    found["sat_duplicates_one_scan"] = sat_duplicates
    for check_id in ("L3", "S3"):
        found[CHECK_KEYS[check_id] + "_shared"] = _check(check_id, shared=True)
    for check_id in ("H2", "L4", "S2", "S5"):
        found[CHECK_KEYS[check_id] + "_hash_first"] = _hash_first(check_id)
    found.update(
        {
            "check_values": _over_report(lambda r: r.results.select("seq", "table_name", "check_id", "value")),
            "check_results": _over_report(
                lambda r: r.results.select(
                    "seq", "category", "table_name", "table_type", "check_id", "check_name", "kind", "impact", "query_text",
                    "value", "status", "error",
                )
            ),
            # The same run with the plans of large parents.
            "check_results_shared": _over_report(
                lambda r: r.results.select("seq", "table_name", "check_id", "value", "status"), broadcast_key_bytes=0
            ),
            "check_results_bucketed": check_results_bucketed,
            "check_results_incremental": check_results_incremental,
            "check_errors": _over_report(
                lambda r: r.results.select("seq", "table_name", "check_id", "value", "status", "error"), vault="quirk"
            ),
            "dq_score": _over_report(lambda r: summary.dq_score(r.results)),
            "run_totals": _over_report(Report.totals),
            "category_summary": _over_report(Report.categories),
            "table_summary": _over_report(Report.tables),
            "failures": _over_report(lambda r: r.failures().drop("error")),
            "results_ordered": _over_report(Report.ordered),
            "score_bands": _over_report(lambda r: summary.score_bands(r.results)),
            "status_labels": _over_report(lambda r: summary.status_labels(r.results)),
            "report_header": _over_report(Report.header),
            "summary_json": _over_report(Report.document),
        }
    )
    return found
