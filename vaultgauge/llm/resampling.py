"""Importance resampling towards a target distribution.

Features are hashed into a fixed number of buckets, and one array holds the gain of each bucket: how much likelier it is in
the target than in the documents. A document's weight is the mean gain of its features, and Gumbel noise from a hash of its
id makes the highest scores a draw without replacement. The k-th highest composite key is found by distributed quickselect:
each round draws random keys as pivots and counts, over all keys that are left, those above, at and below them; only the
stretch that holds the k-th key goes on. The winners alone are sorted and ranked.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.shared import shared_folder, text_of, written

BUCKETS = 10_000
#: Words in a feature: all runs of 1 to this many consecutive words.
LONGEST = 1
SEED = 2024
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20
PERCENT = 10
#: Random keys of one round of the quickselect.
PIVOTS = 15
#: Features that a task keeps. Bounds memory only.
KEPT_FEATURES = 200_000

#: Bytes of words as they are, A-Z lower-cased; the other ASCII bytes become blanks.
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The words of a text in UTF-8: letters and digits of ASCII, lower-cased, and everything beyond ASCII."""
    return text.encode().translate(_WORD_BYTES).split()


def features_of(words: list[bytes], longest: int) -> Iterator[bytes]:
    """All runs of 1 to longest consecutive words."""
    yield from words
    for n in range(2, longest + 1):
        yield from map(b" ".join, zip(*[words[i:] for i in range(n)], strict=False))


class Kept(dict):
    """What a function makes of features that a task has met; at its limit it starts anew."""

    def __init__(self, make: Callable[[bytes], int]):
        self.make = make

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT_FEATURES:
            self.clear()
        value = self[feature] = self.make(feature)
        return value


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket, features: how many features of all texts fall into each bucket that has any.

    Each task adds up its own texts in one array and gives that out, so a frequent word is one row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def add_up() -> None:
            for feature, n in seen.items():
                total[zlib.crc32(feature) % buckets] += n
            seen.clear()

        for batch in batches:
            for text in batch.column(0):
                seen.update(features_of(words_of(text.as_py()), longest))
                if len(seen) > KEPT_FEATURES:
                    add_up()
        add_up()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "features"])

    counted = docs.select(text_of().alias("text")).mapInArrow(count, "bucket bigint, features bigint")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """The gain of each bucket as an array: floor(1000 ln of the ratio of its smoothed shares in target and docs).

    The driver gets one number per bucket and table: their number is a parameter and doesn't grow with the data.
    """
    counts = []
    for df in (target, docs):
        per_bucket = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, buckets, longest).collect():
            per_bucket[r.bucket] = r.features
        counts.append([int(n) for n in per_bucket])
    of_target, of_docs = counts
    t_all, s_all = sum(of_target) + buckets, sum(of_docs) + buckets
    return np.array(
        [math.floor(1000 * math.log(float((t + 1) * s_all) / float((s + 1) * t_all))) for t, s in zip(of_target, of_docs, strict=True)],
        np.int64,
    )


def weights(text: Column, gains: np.ndarray, longest: int = LONGEST) -> Column:
    """n_words, n_features and weight (the floored mean of gains over the features; 0 without any) of a text."""
    per_bucket = gains.tolist()

    @F.arrow_udf("struct<n_words bigint, n_features bigint, weight bigint>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = Kept(lambda feature: per_bucket[zlib.crc32(feature) % len(per_bucket)])
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text.as_py())
                n = sum(max(0, len(words) - i) for i in range(longest))
                rows.append((len(words), n, sum(map(gain.__getitem__, features_of(words, longest))) // n if n else 0))
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["n_words", "n_features", "weight"]
            )

    return score(text)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln -ln u), with u from the first 32 bits of the SHA-256 of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000) * F.ln(-F.ln((h.cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0))))


def composite_key() -> Column:
    """High scores first, then small ids; of rows with one id the one read first. No two rows share a key."""
    return F.struct((-F.col("score")).alias("score"), "doc_id", "row_no")


def _literal(key: tuple) -> str:
    return "named_struct({})".format(", ".join(f"'{n}', bigint('{x}')" for x, n in zip(key, ("score", "doc_id", "row_no"), strict=True)))


def kth_key(keys: DataFrame, k: int, folder: str, pivots: int = PIVOTS) -> tuple | None:
    """The k-th (from 1) of the keys in column key; None where there are fewer.

    Each round: pivots at random among the keys that are left, exact counts of keys before each pivot, at it and after it in
    one aggregation, and the keys strictly between the two pivots around the k-th go on. That is about a `pivots`-th of
    them, written to the shared folder, so the rounds together read little more than the first. The driver holds the pivots.
    """
    left, rank, step = keys, k, 0
    while True:
        drawn = left.orderBy(F.xxhash64(F.lit(step), "key"), "key").limit(pivots).collect()
        chosen = sorted(tuple(r.key) for r in drawn)
        if not chosen or rank < 1:
            return None
        known = f"array({', '.join(map(_literal, chosen))})"
        # Where a key lies among the pivots: 2 i before the i-th, 2 i + 1 at it.
        places = left.selectExpr(f"2 * size(filter({known}, p -> p < key)) + int(array_contains({known}, key)) AS place")
        counts = {r.place: r.n for r in places.groupBy("place").agg(F.count("*").alias("n")).collect()}
        if rank > sum(counts.values()):
            return None
        skipped = at = 0
        while skipped + counts.get(at, 0) < rank:
            skipped, at = skipped + counts.get(at, 0), at + 1
        if at % 2:
            return chosen[at // 2]
        if at:
            left = left.where(f"key > {_literal(chosen[at // 2 - 1])}")
        if at // 2 < len(chosen):
            left = left.where(f"key < {_literal(chosen[at // 2])}")
        left, rank, step = written(left, f"{folder}/left-{step}"), rank - skipped, step + 1


def ranked(rows: DataFrame, folder: str) -> DataFrame:
    """The rows with their rank (from 1) by column key: sorted over all tasks, numbered within each, and shifted by the tasks before.

    Only the number of rows per task is summed up in one place.
    """
    position = F.monotonically_increasing_id()
    in_order = written(
        rows.orderBy("key").withColumns({"task": F.shiftright(position, 33), "place": position.bitwiseAND((1 << 33) - 1)}),
        f"{folder}/ranked",
    )
    sizes = sorted((r.task, r.n) for r in in_order.groupBy("task").agg(F.count("*").alias("n")).collect())
    starts = np.cumsum([1, *[n for _, n in sizes]]).tolist()
    first = rows.sparkSession.createDataFrame(
        [(task, start) for (task, _), start in zip(sizes, starts, strict=False)], "task bigint, first bigint"
    )
    numbered = in_order.join(F.broadcast(first), "task")  # a row per task
    return numbered.withColumn("rank", F.col("first") + F.col("place")).drop("task", "place", "first")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of docs; rank counts the drawn ones from 1 and is null for the others.

    Drawn are floor(percent * N / 100) of the N rows with an id and least_words words: those with the highest scores,
    ties to the smaller id. target has a column text; nulls in either text count as empty, and an empty text has no
    features and weight 0. A null id has no score and is never drawn. Rows that repeat count each, and are drawn
    one by one; of equal keys the row that was read first goes first. Other columns are left out. An empty table of
    documents gives no rows; an empty target makes all gains those of smoothing alone.
    """
    folder = shared_folder(docs.sparkSession, "resampling")
    gains = bucket_gains(docs, target, buckets, longest)
    scored = docs.select("doc_id", weights(text_of(), gains, longest).alias("of")).select(
        "doc_id", "of.n_words", "of.n_features", "of.weight", (F.col("of.weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    scored = written(scored.withColumn("key", composite_key()), f"{folder}/scored")
    takes_part = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    able = scored.where(takes_part).select("key")
    last = kth_key(able, able.count() * percent // 100, folder)
    columns = ["doc_id", "n_features", "weight", "score"]
    no_rank = F.lit(None).cast("bigint").alias("rank")
    if last is None:
        return scored.select(*columns, no_rank)
    is_drawn = takes_part & F.expr(f"key <= {_literal(last)}")
    drawn = ranked(scored.where(is_drawn).select(*columns, "key"), folder).select(*columns, "rank")
    return drawn.unionByName(scored.where(~is_drawn).select(*columns, no_rank))
