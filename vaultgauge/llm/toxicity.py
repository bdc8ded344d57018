"""Toxicity by compression distance: windows of a text are compressed with a dictionary of ordinary text and with dictionaries of
toxic text; bytes saved by these speak for toxicity.

- The ordinary dictionary is trained by zstandard on windows of documents labelled ordinary, the toxic one likewise on windows of
  documents labelled toxic: it holds whole phrases, also those made of words that are ordinary by themselves.
- Labels belong to whole documents, most words of which are ordinary, so the trained toxic dictionary alone tells little where
  toxicity lies in single words. A third one is an addition: the ordinary one and the words that occur in toxic documents far more
  often than chance (G-test; contexts that repeat, as in copies, count once).
- Every window is preceded by a fixed header that all dictionaries hold. So each window compresses to a block of the same kind,
  and lengths differ by what the dictionaries match in the window, not by zstandard's fallback to uncompressed blocks.
- Spaces and a fixed tail close a window, so that words at its edges match like the others. Dictionaries without toxic words hold
  filler in their place, so that what matches ordinary text costs the same with all of them: a single short word saves 3 bytes or so.
- Savings per window become a score by a logistic function of three summaries for each toxic dictionary, with thresholds fitted to labelled documents.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.llm.shared import give_back, hashed_share, held_out, shared_folder, text_of, written

WINDOW_WORDS = 8
#: Labelled documents of each class from which the model learns, at most (about: a share of the ids by hash).
SAMPLE_DOCUMENTS = 5_000
#: Windows that train a dictionary, at most; bytes of the dictionary that are used.
DICTIONARY_WINDOWS, DICTIONARY_BYTES = 60_000, 15_000
#: Length of the pieces of text that a trained dictionary is made of: words for ordinary text, whole phrases for toxic text.
ORDINARY_PIECE, TOXIC_PIECE = 32, 200
#: G statistic from which a word counts as toxic, and the number of such words at most.
SIGNIFICANT, TOXIC_WORDS = 20.0, 2_000
#: Bytes saved from which a window counts.
SAVED = (3, 4)
#: A document is toxic from this score on.
THRESHOLD = 0.5
HEADER = bytes([*range(1, 9), *range(14, 22), *range(128, 176)])
#: Closes every window: the library looks for no match in the last eight bytes of its input.
TAIL = bytes(range(22, 30))
#: Bytes that UTF-8 never has.
NO_TEXT = bytes([0xC0, 0xC1, *range(0xF5, 0x100)])


def words(text: str) -> list[str]:
    return text.lower().split()


def windows(text: str) -> list[bytes]:
    """The whole text in runs of eight words, between spaces."""
    w = words(text)
    return [f" {' '.join(w[i : i + WINDOW_WORDS])} ".encode() for i in range(0, len(w), WINDOW_WORDS)]


@functools.lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=16, hash_log=15, chain_log=15, search_log=4, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


@dataclass(frozen=True)
class Distance:
    """The dictionaries (ordinary, trained toxic, ordinary with toxic words), and the weights of the summaries (the last one is the intercept)."""

    ordinary: bytes
    toxic: bytes
    worded: bytes
    weights: tuple[float, ...] = ()

    @classmethod
    def of(cls, ordinary: bytes, toxic: bytes, found: list[str]) -> Distance:
        """The dictionaries alike in size: where one holds the toxic words, the others hold bytes that no text has. So a match in
        the ordinary part lies equally far back in all of them, and only what the words match makes a difference."""
        listed = f" {' '.join(found)} ".encode()
        filler = bytes(random.Random(0).choices(NO_TEXT, k=len(listed)))
        return cls(ordinary + filler + HEADER, toxic + filler + HEADER, ordinary + listed + HEADER)

    def summaries(self, text: str) -> list[float]:
        """Largest saving of a window, and savings above each threshold against the number of windows, by each toxic dictionary."""
        plain, *toxic = (_compressor(d).compress for d in (self.ordinary, self.worded, self.toxic))
        found = [HEADER + w + TAIL for w in windows(text)]
        lengths = [len(plain(w)) for w in found]
        values = []
        for compress in toxic:
            saved = [n - len(compress(w)) for n, w in zip(lengths, found, strict=True)]
            low, high = (sum(s for s in saved if s >= least) for least in SAVED)
            values += [math.log1p(max([0, *saved])), math.log1p(low / math.sqrt(10 + len(found))), math.log1p(10 * high / (5 + len(found)))]
        return values

    def score(self, text: str) -> float:
        *slopes, intercept = self.weights
        z = sum(a * b for a, b in zip(slopes, self.summaries(text), strict=True)) + intercept
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled documents that aren't held out, about size of each class at most, with their label; how many there are of each."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    of_class = [(F.col("label") == c) & hashed_share("doc_id", size / n) for c, n in counts.items()]
    ids = known.where(functools.reduce(Column.__or__, of_class, F.lit(False)))
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id")  # about two times size ids, by the counts
    return rows, counts


def _trained(of_class: DataFrame, piece: int) -> bytes:
    """A dictionary that zstandard trains on windows of a class, those with the least hashes."""
    found = [bytes(r["w"]) for r in of_class.orderBy(F.xxhash64("w"), "w").limit(DICTIONARY_WINDOWS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES + 1_000, found, k=piece, d=8).as_bytes()[-DICTIONARY_BYTES:]
    except zstandard.ZstdError:  # too little text to train on: it is the dictionary itself
        return b"\n".join(found)[-DICTIONARY_BYTES:]


def _toxic_words(sample: DataFrame, counts: dict[int, int]) -> list[str]:
    """The significant words, the most significant last."""
    w = F.transform(F.array_remove(F.split(F.lower("text"), r"\s+"), ""), lambda x: F.btrim(x, F.lit(".,!?;:#%&*$|\"'()")))
    rows = sample.select("doc_id", "label", w.alias("w")).where(F.size("w") > 0)
    at = lambda i: F.coalesce(F.get(F.col("w"), i), F.lit(""))
    triples = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.struct(at(i).alias("word"), at(i - 1).alias("before"), at(i + 1).alias("after")))
    rows = rows.select("doc_id", "label", F.explode(triples).alias("t")).select("doc_id", "label", "t.*").where("word <> ''")
    contexts = rows.select("word", "before", "after", "label").distinct().groupBy("word").agg(
        F.sum("label").alias("toxic_contexts"), F.sum(1 - F.col("label")).alias("contexts")
    )
    documents = rows.select("word", "doc_id", "label").distinct().groupBy("word").agg(
        F.sum("label").alias("toxic_documents"), F.sum(1 - F.col("label")).alias("documents")
    )
    k = F.least("toxic_contexts", "toxic_documents")
    m = F.greatest("contexts", "documents")
    p = counts[1] / (counts[0] + counts[1])
    n = k + m
    g = 2 * (k * F.log(k / n / p) + F.when(m > 0, m * F.log(m / n / (1 - p))).otherwise(0.0))
    found = contexts.join(documents, "word").where((k > 0) & (k / n >= min(3 * p, (1 + p) / 2))).select("word", g.alias("g"))
    top = found.where(F.col("g") >= SIGNIFICANT).orderBy(F.desc("g"), "word").limit(TOXIC_WORDS).collect()
    return [r["word"] for r in reversed(top)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE_DOCUMENTS) -> Distance | None:
    """Learns from a bounded sample of the labelled documents that aren't held out; None where a class has none."""
    sample, counts = _sample(docs, labels, label, size)
    if len(counts) < 2:
        return None
    sample = written(sample, f"{shared_folder(docs.sparkSession, 'toxicity')}/sample")  # read several times, and the texts of all only once

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([windows(t) for t in texts.to_pylist()], pa.list_(pa.binary()))

    taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(taken) < 2:
        return None
    found = _toxic_words(sample, taken)
    # the trained toxic dictionary knows its own documents by heart: the weights are fitted to the other half
    learns = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    halves = {(r["label"], r["learns"]) for r in sample.select("label", learns.alias("learns")).distinct().collect()}
    if len(halves) < 4:  # too few documents to be divided
        learns = F.lit(True)
    weighed = sample.where(~learns) if len(halves) == 4 else sample
    cut_out = lambda rows: rows.select(F.explode(cut(F.col("text"))).alias("w"))
    ordinary = _trained(cut_out(sample.where("label = 0")), ORDINARY_PIECE)
    toxic = _trained(cut_out(sample.where((F.col("label") == 1) & learns)), TOXIC_PIECE)
    distance = Distance.of(ordinary, toxic, found)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def summaries(texts: pa.Array) -> pa.Array:
        return pa.array([distance.summaries(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    seen = weighed.select("label", summaries(F.col("text")).alias("x")).toPandas()
    weights = _logistic(np.stack(seen["x"]), seen["label"].to_numpy(float))
    toxic_share = seen["label"].mean()
    weights[-1] += math.log(counts[1] / counts[0]) - math.log(toxic_share / (1 - toxic_share))  # classes are sampled apart
    return Distance(distance.ordinary, distance.toxic, distance.worded, tuple(map(float, weights)))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression with an intercept, by Newton's method."""
    a = np.column_stack([x, np.ones(len(x))])
    penalty = ridge * np.diag([*[1.0] * x.shape[1], 1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(len(w)), a.T @ (p - y) + penalty @ w)
    return w


def score_column(model: Distance | None, text: Column) -> Column:
    """The probability that a text is toxic; 0 for each text without a model."""

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield pa.array([model.score(t.as_py()) for t in texts], pa.float64())
        finally:
            give_back()

    return score(text) if model else F.lit(0.0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: toxic likelier).

    Only the text enters a score; whole texts are scored. A null text is empty; an empty text gets the score of no saving.
    Rows with a null id are scored, but never learnt from. Without labels of both classes each score is 0.
    """
    return docs.select("doc_id", held_out().alias("held_out"), score_column(fit(docs, labels, label), text_of()).alias("score"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs below the threshold, with all their columns."""
    name = "__score"
    return docs.withColumn(name, score_column(fit(docs, labels), text_of())).where(F.col(name) < threshold).drop(name)
