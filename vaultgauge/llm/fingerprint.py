"""Document fingerprints by one-permutation MinHash.

The hashes of a text's word shingles are computed once and dealt into bins by their high bits; the smallest hash of each
bin counts. An empty bin takes the value of that filled bin which comes first in the empty bin's own random order of bins:
optimal densification (each empty bin draws independently, the same way for every text). Of each bin the low-order bits
are packed into a hexadecimal string. The likeness of two fingerprints is the share of equal bins, corrected for bins
that are equal by chance.

Native: DataFrame functions only, no Python.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultgauge.llm.shared import shared_folder, text_of, written

SHINGLE_WORDS = 5
BINS = 128
#: Low-order bits kept of each bin: one byte, two hexadecimal digits.
BITS = 8
LOW_31 = (1 << 31) - 1
#: Bits of a hash below those of its bin, and all of them set.
HASH_BITS = 65 - BINS.bit_length()
EMPTY = (1 << HASH_BITS) - 1


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def _shingle_hashes(words: str) -> Column:
    """Hashes of all runs of five words; fewer words are one shingle, no words none. words names a column: an expression would
    be evaluated anew for each run."""
    last = F.greatest(F.size(words) - (SHINGLE_WORDS - 1), F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, SHINGLE_WORDS)))
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, HASH_BITS)


def _constants(values: list) -> Column:
    return F.array(*map(F.lit, values))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column: BINS bytes in hexadecimal, '' for a text without words.

    Null counts as empty. Equal texts get equal fingerprints, whatever else is in the table.
    """
    draws = random.Random(10)
    long = lambda values: _constants(values).cast("array<bigint>")
    draw_of_empty, draw_of_filled = (long([draws.randrange(1, LOW_31) for _ in range(BINS)]) for _ in range(2))
    bins = [(i + BINS // 2) % BINS for i in range(BINS)]  # sorted as signed numbers, the upper half of the bins comes first
    last_of_bin = [((b << HASH_BITS | EMPTY) ^ 1 << 63) - (1 << 63) for b in bins]  # the largest hash of each bin stands for an empty one
    is_empty = lambda h: h.bitwiseAND(EMPTY) == EMPTY
    df = df.withColumn("__words", _words(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn("__hashes", F.sort_array(F.concat(_shingle_hashes("__words"), long(last_of_bin))))
    # sorted, the hashes of a bin lie together: the first of each run is the bin's minimum
    first = lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(F.col("__hashes"), i - 1)))
    df = df.withColumn("__minima", F.filter("__hashes", first))
    places = F.transform("__minima", lambda h, i: F.when(is_empty(h), None).otherwise(F.get(draw_of_filled, i) * BINS + i))
    df = df.withColumn("__filled", F.array_compact(places))

    def value(h: Column, i: Column) -> Column:
        """The bin's minimum, or that of the filled bin which the empty bin's order of bins puts first."""
        order = F.transform("__filled", lambda f: F.get(draw_of_empty, i) * F.shiftright(f, BINS.bit_length() - 1) % LOW_31 * BINS + f % BINS)
        return F.when(is_empty(h), F.get(F.col("__minima"), (F.array_min(order) % BINS).cast("int"))).otherwise(h)

    digits = _constants([f"{v:0{BITS // 4}x}" for v in range(1 << BITS)])
    code = F.transform("__minima", lambda h, i: F.get(digits, value(h, i).bitwiseAND((1 << BITS) - 1)))
    return df.withColumn(name, F.when(F.size("__words") > 0, F.concat_ws("", code)).otherwise("")).drop(
        "__words", "__hashes", "__minima", "__filled"
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1; texts without words are like each other only."""
    digits = BITS // 4
    part = lambda c, i: F.substring(c, i * digits + 1, F.lit(digits))
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: part(a, i) == part(b, i)))
    chance = 1 / (1 << BITS)
    estimate = F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(estimate)


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, need: of each distinct id the next smaller one (after the smallest: the largest; null comes last), and
    a third of the length of the longest text of that id.

    Ids are sorted in ranges, so no task sees them all; only the first id of each range meets in one task.
    """
    spark = docs.sparkSession
    need = docs.groupBy("doc_id").agg(F.max(F.floor(F.length(text_of()) / 3)).cast("int").alias("need"))
    placed = written(
        need.repartitionByRange(F.desc_nulls_last("doc_id")).withColumn("part", F.spark_partition_id()),
        f"{shared_folder(spark, 'neighbours')}/placed",
    )
    ids = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"))
    parts = Window.orderBy("part")
    heads = placed.groupBy("part").agg(F.struct(F.max("doc_id").alias("doc_id")).alias("head"))
    heads = heads.select(
        "part",
        F.coalesce(F.lead("head").over(parts), F.first("head").over(parts)).alias("next_head"),
    )
    after = F.coalesce(F.lead(F.struct("doc_id")).over(ids), F.col("next_head"))
    return placed.join(F.broadcast(heads), "part").select("doc_id", after["doc_id"].alias("next_id"), "need")  # a row a range


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Of each row: its text's fingerprint, that of the text with its last third replaced, and how alike they are.

    The last floor(n / 3) code points give way to the first as many of the next document, by descending doc_id. Null text
    is empty. Rows that share an id share their neighbour; of a neighbour's several texts the smallest beginning counts.
    """
    base = with_fingerprint(docs.select("doc_id", text_of().alias("text")), "text", "fingerprint")
    beside = neighbours(docs)
    begins = (
        base.join(beside.withColumnRenamed("doc_id", "for_id"), F.col("doc_id").eqNullSafe(F.col("next_id")))
        .groupBy("for_id")
        .agg(F.min(F.struct(F.left("text", F.col("need")).alias("begin"), F.col("fingerprint").alias("fingerprint"))).alias("next"))
    )
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - third), F.left("next.begin", third))
    joined = base.join(begins, F.col("doc_id").eqNullSafe(F.col("for_id"))).select(
        "doc_id", "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"), F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited")
    )
    return with_fingerprint(joined, "edited", "edited_fingerprint").select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
