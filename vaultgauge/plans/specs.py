"""The checks of a vault: the registry of check templates joined with the catalog."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultgauge import rules
from vaultgauge.functions.sqltext import literal, quoted_where_needed
from vaultgauge.plans.catalog import REFERENCED_KEYS, owners
from vaultgauge.settings import Settings


def _registry(spark: SparkSession, settings: Settings) -> DataFrame:
    """The check templates with the settings of the run filled in, one row per table kind."""

    def with_settings(text: str) -> str:
        for name in ("stale_hours", "spike_multiplier", "spike_window_days", "single_source_percent"):
            text = text.replace("{" + name + "}", str(getattr(settings, name)))
        return text.replace("{now}", settings.as_of).replace("{today}", settings.as_of[:10])

    rows = [
        {
            "table_type": table_type,
            "per_reference": c.per_reference,
            "check_id": c.check_id,
            "stage": c.stage,
            "rank": rank,
            "category": c.category,
            "kind": c.kind,
            "needs": list(c.needs),
            "name": with_settings(c.name),
            "impact": with_settings(c.impact),
            "query": with_settings(c.query),
        }
        for rank, c in enumerate(rules.CHECKS)
        for table_type in c.table_types
    ]
    schema = pa.schema(
        [
            ("table_type", pa.string()),
            ("per_reference", pa.bool_()),
            ("check_id", pa.string()),
            ("stage", pa.int64()),
            ("rank", pa.int64()),
            ("category", pa.string()),
            ("kind", pa.string()),
            ("needs", pa.list_(pa.string())),
            ("name", pa.string()),
            ("impact", pa.string()),
            ("query", pa.string()),
        ]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def _filled(template: str, values: dict[str, str]) -> str:
    return reduce(lambda text, v: f"replace({text}, {literal('{' + v[0] + '}')}, {v[1]})", values.items(), template)


def check_specs(tables: DataFrame, settings: Settings, qualifier: Sequence[str] = ()) -> DataFrame:
    """One row per check to run. `slot` names the check within its table, `generation_order` is theirs."""
    # A check of the table itself sees the parent of a satellite; a check per foreign key sees that key and its parent.
    itself = """named_struct('per_reference', false, 'reference_no', 0,
                             'key_column', CASE WHEN table_type = 'SAT' THEN own_hk END)"""
    foreign_keys = f"CASE WHEN table_type = 'LINK' THEN {REFERENCED_KEYS} ELSE array() END"
    per_key = "(k, n) -> named_struct('per_reference', true, 'reference_no', n, 'key_column', k)"
    targets = tables.selectExpr(
        "*", f"inline(array_append(transform({foreign_keys}, {per_key}), {itself}))"
    ).join(owners(tables, settings), "key_column", "left")
    present = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {literal(c)} END"
        for c in (rules.OWN_KEY, rules.PARENT, "load_dts_col", "record_source_col", "hash_diff_col")
    )
    any_key = f"CASE WHEN size(hk_columns) > 0 THEN {literal(rules.ANY_KEY)} END"
    checks = (
        # The registry has one row per check template and table kind.
        targets.join(F.broadcast(_registry(tables.sparkSession, settings)), ["table_type", "per_reference"])
        .filter(f"size(array_except(needs, array({present}, {any_key}))) = 0")
    )

    database = [quoted_where_needed(literal(part)) for part in qualifier]

    def full_name(name: str) -> str:
        return f"concat_ws('.', {', '.join([*database, quoted_where_needed(name)])})"

    names = {
        "own": "coalesce(own_hk, '')",
        "key_name": "coalesce(key_column, '')",
        "parent": "coalesce(parent_name, '')",
        "diff_name": "coalesce(hash_diff_col, '')",
    }
    sql_parts = {
        "table": full_name("source_name"),
        "parent_table": f"coalesce({full_name('parent_source_name')}, '')",
        "combo": f"array_join(transform(hk_columns, k -> {quoted_where_needed('k')}), ', ')",
        **{
            part: f"coalesce({quoted_where_needed(column)}, '')"
            for part, column in {
                "own_sql": "own_hk",
                "key": "key_column",
                "load": "load_dts_col",
                "source": "record_source_col",
                "diff": "hash_diff_col",
            }.items()
        },
    }
    return checks.selectExpr(
        "position * 10000000L + stage * 100000 + reference_no * 100 + rank AS generation_order",
        "category",
        "table_name",
        "source_name",
        "table_type",
        "check_id",
        "CASE WHEN per_reference THEN concat(check_id, ':', key_column) ELSE check_id END AS slot",
        f"{_filled('name', names)} AS check_name",
        "kind",
        "impact",
        f"{_filled('query', sql_parts)} AS query_text",
        "key_column",
        "parent_name",
    )
