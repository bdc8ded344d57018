"""Removal of repeated runs of lines, across and within documents, by a suffix array over line ids.

Lines that occur once end any repeated run, so only lines that occur more often take part. Their suffixes are ranked by
distributed prefix doubling: from ranks by the first h lines, the pairs of ranks at i and i + h are sorted in ranges and give
the ranks by the first 2h lines. Suffixes of one rank form an LCP interval: they share that many lines; an interval of any
depth d is the pair of ranks, by the largest power of two h that fits, at i and at i + d - h. A suffix that shares its
rank with none is dropped, so the tables shrink with each step.

A run counts from a number of words on. How many lines from a line on (or back) make up that number depends on these lines
only. So equal runs have equal shortest runs, and the shortest ones, forward from and back to each line, cover exactly the lines of
the maximal ones. In each interval of shortest runs the first in document order stays and later ones are deleted.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.llm.shared import shared_folder, text_of, written

#: Words from which a repeated run counts.
MIN_WORDS = 50
# Fixed value: what counts as white space around a line.
BLANKS = " \t\n\x0b\f\r"

DOC = ["doc_id", "text_hash"]


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with words: doc_id, text_hash, idx (counting such lines), line (128-bit digest without outer spaces), words."""
    trimmed = F.transform(F.split(text_of(), "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), F.posexplode(F.filter(trimmed, lambda s: s != "")).alias("idx", "s"))
    return rows.select(*DOC, "idx", F.unhex(F.md5("s")).alias("line"), F.size(F.split("s", r"\s+")).alias("words"))


def _ranked(keys: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Adds rank to distinct keys with a count n: the number of suffixes with a smaller key. Sorted in ranges, with an offset per range."""
    placed = written(keys.repartitionByRange(*columns).withColumn("part", F.spark_partition_id()), path)
    totals = placed.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("n").over(within), F.lit(0)) + F.col("offset")
    return placed.join(F.broadcast(offsets), "part").select(*columns, rank.alias("rank"))  # a row a range


def suffix_ranks(docs: DataFrame, folder: str, most_lines: int) -> dict[int, DataFrame]:
    """By h = 1, 2, 4, ... up to most_lines: doc_id, text_hash, idx, rank of suffixes whose first h lines occur elsewhere, too.

    The table for 1 also has words. Rows that repeat an id and its text count as one document.
    """
    lines = written(_lines(docs), f"{folder}/lines")
    repeated = lines.groupBy("line").agg(F.count("*").alias("n")).where("n > 1")
    first = lines.join(_ranked(repeated, ["line"], f"{folder}/keys-1"), "line").dropDuplicates([*DOC, "idx"])
    ranks = {1: written(first.select(*DOC, "idx", "words", "rank"), f"{folder}/ranks-1")}
    h = 1
    while 2 * h <= most_lines:
        here = ranks[h].select(*DOC, "idx", "rank")
        there = here.select(*DOC, (F.col("idx") - h).alias("idx"), F.col("rank").alias("next"))
        pairs = written(_same_document(here, there, ["idx"]), f"{folder}/pairs-{2 * h}")
        shared = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
        keys = _ranked(shared.withColumnRenamed("rank", "here"), ["here", "next"], f"{folder}/keys-{2 * h}")
        named = pairs.withColumnRenamed("rank", "here").join(keys, ["here", "next"]).select(*DOC, "idx", "rank")
        ranks[2 * h] = written(named, f"{folder}/ranks-{2 * h}")
        h *= 2
    return ranks


def _same_document(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on the document and further keys; a null id is an id like any other."""
    b = b.withColumnsRenamed({k: f"b_{k}" for k in [*DOC, *keys]})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"b_{k}")) if k == "doc_id" else F.col(k) == F.col(f"b_{k}") for k in [*DOC, *keys]])
    return a.join(b, on).drop(*[f"b_{k}" for k in [*DOC, *keys]])


def _shortest_runs(first: DataFrame, min_words: int) -> DataFrame:
    """doc_id, text_hash, start, depth: for each repeated line the shortest run of repeated lines with enough words that begins, and that ends there."""
    row = F.col("idx") - F.row_number().over(Window.partitionBy(*DOC).orderBy("idx"))  # the same within a stretch without gaps
    rows = first.select(*DOC, "idx", "words", row.alias("stretch"))
    stretch = Window.partitionBy(*DOC, "stretch").orderBy("idx")
    upto = F.sum("words").over(stretch.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
    whole = Window.partitionBy(*DOC, "stretch").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # From the last line back: a frame that grows is kept up, one that shrinks would be built anew for each line.
    by_before = Window.partitionBy(*DOC, "stretch").orderBy(F.col("before").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    by_upto = Window.partitionBy(*DOC, "stretch").orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    rows = rows.withColumns(
        {
            "begin": F.min("idx").over(whole), "end": F.max("idx").over(whole) + 1, "total": F.max("upto").over(whole),
            "next_start": F.min("idx").over(by_before), "last_end": F.max("idx").over(by_upto),
        }
    )
    forward = F.coalesce("next_start", F.when(F.col("total") - F.col("before") >= min_words, F.col("end")))
    back = F.coalesce(F.col("last_end") + 1, F.when(F.col("upto") >= min_words, F.col("begin")))
    runs = F.array(
        F.struct(F.col("idx").alias("start"), (forward - F.col("idx")).alias("depth")),
        F.struct(back.alias("start"), (F.col("idx") + 1 - back).alias("depth")),
    )
    return rows.select(*DOC, F.explode(runs).alias("r")).select(*DOC, "r.*").where("start is not null and depth is not null").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, idx of the lines that lie in a later copy of a run of lines with min_words words or more.

    Documents are in the order of their ids (null first; of one id by a hash of the text). A copy that overlaps the first one of the
    same document stays. idx counts the lines with words from 0 on.
    """
    folder = shared_folder(docs.sparkSession, "line-dedup")
    ranks = suffix_ranks(docs, folder, min_words)
    runs = _shortest_runs(ranks[1], min_words)
    power = reduce(lambda c, h: F.when(F.col("depth") >= h, h).otherwise(c), sorted(ranks), F.lit(1))
    runs = runs.withColumn("h", power)
    table = reduce(DataFrame.union, [r.select(*DOC, "idx", "rank", F.lit(h).alias("h")) for h, r in ranks.items()])
    at_start = table.select(*DOC, F.col("idx").alias("start"), "h", F.col("rank").alias("first_rank"))
    at_end = table.select(*DOC, F.col("idx").alias("tail"), "h", F.col("rank").alias("last_rank"))
    runs = _same_document(runs, at_start, ["start", "h"]).withColumn("tail", F.col("start") + F.col("depth") - F.col("h"))
    runs = written(_same_document(runs, at_end, ["tail", "h"]), f"{folder}/runs")
    interval = ["depth", "first_rank", "last_rank"]
    place = F.struct(*DOC, "start")
    firsts = runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    later = runs.join(firsts, interval).where(~same | (F.col("start") >= F.col("first.start") + F.col("depth")))
    return later.select(*DOC, F.explode(F.sequence("start", F.col("start") + F.col("depth") - 1)).alias("idx")).distinct()


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, n_lines (lines with words), n_deleted, text without the lines of later copies.

    Lines are equal without the white space around them. Lines without words are kept where they are, count for nothing and don't
    interrupt a run. Null text is empty; rows that repeat an id and its text count as one document and are all returned.
    """
    deleted = later_copies(docs, min_words).groupBy(*DOC).agg(F.sort_array(F.collect_list("idx")).alias("deleted"))  # a document's lines at most
    rows = docs.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("text_hash"))
    deleted = deleted.withColumnsRenamed({"doc_id": "d_id", "text_hash": "d_hash"})
    rows = rows.join(deleted, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash")), "left")
    left = _without("text", "deleted")
    return rows.select("doc_id", "text", "deleted", left.alias("left")).select(
        "doc_id",
        F.col("left.n_lines").alias("n_lines"),
        F.coalesce(F.size("deleted"), F.lit(0)).alias("n_deleted"),
        F.coalesce("left.text", "text").alias("text"),
    )


@F.arrow_udf(T.StructType([T.StructField("n_lines", T.IntegerType()), T.StructField("text", T.StringType())]))
def _without(texts: pa.Array, deleted: pa.Array) -> pa.Array:
    """The number of a text's lines with words, and the text without those whose numbers are given; null: as it is."""
    counts, left = [], []
    for text, numbers in zip(texts, deleted, strict=True):
        lines = text.as_py().split("\n")
        with_words = [i for i, line in enumerate(lines) if line.strip(BLANKS)]
        counts.append(len(with_words))
        numbers = numbers.as_py()
        if numbers:
            gone = {with_words[n] for n in numbers}
            left.append("\n".join(line for i, line in enumerate(lines) if i not in gone))
        else:
            left.append(None)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int32()), pa.array(left, pa.string())], ["n_lines", "text"])
