"""Rows whose key does not occur in the parent. NULL keys are orphans; copies in the parent do not matter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.functions.sqltext import quoted

# Per parent row in a broadcast hash table, besides the key itself.
BYTES_PER_BROADCAST_ROW = 64


class Child(NamedTuple):
    table_name: str
    slot: str
    frame: DataFrame
    key: str


def fits_broadcast(rows: int | None, key_bytes: int | None, limit: int) -> bool:
    """True only for a measured size below the limit."""
    return rows is not None and key_bytes is not None and key_bytes + rows * BYTES_PER_BROADCAST_ROW <= limit


def orphan_rows(
    child: Child, parent: DataFrame, broadcast_parent: bool = False, broadcast_child: bool = False
) -> DataFrame:
    """Anti join of the child's distinct keys, with their number of rows, and the parent's distinct keys.

    With a parent known to be small the anti join runs ahead of the grouping and only orphans are shuffled. With a child
    known to be small its keys go to the parent, which isn't shuffled. Otherwise both are grouped first, so that a key with
    most of the rows is one row in the join.
    """
    key = F.col(quoted(child.key))
    parent_keys = parent.select(key.alias("parent_key"))
    if broadcast_parent:
        orphans = child.frame.select(key.alias("child_key")).join(
            F.broadcast(parent_keys), F.col("child_key") == F.col("parent_key"), "left_anti"
        )
        return orphans.agg(F.count(F.lit(1)).alias("value"))
    per_key = child.frame.groupBy(key.alias("child_key")).agg(F.count(F.lit(1)).alias("copies"))
    parent_keys = parent_keys.distinct()
    if broadcast_child:
        wanted = F.broadcast(per_key.select(F.col("child_key").alias("wanted_key")))
        met = parent.select(key.alias("parent_key")).join(wanted, F.col("parent_key") == F.col("wanted_key"), "left_semi")
        parent_keys = F.broadcast(met.distinct())  # keys of the child only
    orphans = per_key.join(parent_keys, F.col("child_key") == F.col("parent_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("value"))


def shared_key_figures(parent: DataFrame, key: str, children: Sequence[Child]) -> DataFrame:
    """Orphans of all children of a parent, and its own duplicate keys, from one grouping by key.

    The keys of the parent and of its children are put together and counted by origin. The parent is scanned and
    shuffled once instead of once per child, and partial aggregation leaves one row per key and task, however often a
    key occurs. An aggregate that doesn't fit in memory sorts what it spills.
    Columns: duplicate_groups (of the parent), orphans_<n> for the n-th child.
    """
    origins = [(parent, key)] + [(c.frame, c.key) for c in children]
    keys = reduce(
        DataFrame.unionAll,
        [frame.selectExpr(f"{quoted(name)} AS key", f"{n} AS origin") for n, (frame, name) in enumerate(origins)],
    )
    per_key = keys.groupBy("key").agg(
        *[F.expr(f"count(CASE WHEN origin = {n} THEN 1 END) AS rows_{n}") for n in range(len(origins))]
    )
    return per_key.selectExpr(
        "count(CASE WHEN rows_0 > 1 THEN 1 END) AS duplicate_groups",
        *[
            f"coalesce(sum(CASE WHEN key IS NULL OR rows_0 = 0 THEN rows_{n} END), 0) AS orphans_{n}"
            for n in range(1, len(origins))
        ],
    )
