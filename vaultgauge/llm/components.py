"""Connected components by alternating large-star and small-star steps, as tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.shared import written


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, root for each node of the edges (columns a, b): root is the smallest node that it is linked to, over any number of links.

    Each step aggregates neighbours to their minimum before anything is joined, so a hub's links are never gathered in one
    place; the join back deals them out by the other end.
    """
    step, seen = 0, None
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        edges = written(edges, f"{folder}/edges-{step}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(
                edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
            )  # stars around their smallest node: no b is an a
        seen = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        step += 1
