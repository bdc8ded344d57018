"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One pass over the texts gives each document's statistics. Spark sums them and their products per class, which gives the
means and covariances; each covariance is shrunk towards a multiple of the identity and factored once. The score is the
difference of the Gaussian log-densities (Mahalanobis distances by the cached Cholesky factors), calibrated to a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.llm.shared import give_back, hashed_share, held_out, shared_folder, text_of, written

STATISTICS = (
    "words", "word_length", "word_spread", "variety", "pair_variety", "commonest", "upper", "symbols", "marked_words",
    "bars", "marks", "digits", "line_repeats", "line_length",
)
#: Labelled rows on which the calibration is fitted, at most (about: a share of the ids by hash); means and covariances use all of them.
CALIBRATION_ROWS = 20_000
#: Weight of the identity in a class covariance.
SHRINKAGE = 0.01

_UPPER = np.arange(65, 91)
_DIGIT = np.arange(48, 58)
_MARK = np.array([ord(c) for c in ".,;:'\"-?()"])
_SYMBOL = np.array([b for b in range(33, 127) if not chr(b).isalnum() and b not in _MARK])


def statistics(text: str) -> list[float]:
    """Transformed statistics of a whole text; an empty text has zeros throughout."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    of_byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, len(text) - of_byte[32] - of_byte[10])
    share = lambda which: of_byte[which].sum() / size
    plain = sum(k for w, k in counts.items() if w.rstrip(".,;:?\"')").isalnum())
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n),
        np.log(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(len(counts)) / np.log1p(n),
        np.log1p(len(set(pairwise(words)))) / np.log1p(n),
        np.sqrt(max(counts.values()) / n),
        np.sqrt(share(_UPPER)),
        np.sqrt(share(_SYMBOL)),
        np.sqrt(1 - plain / n),
        np.sqrt(share(124)),
        np.sqrt(share(_MARK)),
        np.sqrt(share(_DIGIT)),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.log1p(n / len(lines)),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    try:
        for texts in batches:
            yield pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))
    finally:
        give_back()


def with_statistics(docs: DataFrame, name: str = "statistics") -> DataFrame:
    return docs.withColumn(name, _statistics(text_of()))


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of two Gaussians, and the calibration of their difference."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, for each row."""
        x = (rows - self.centre) / self.scale
        density = [self.offsets[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(1) for c in (0, 1)]
        return density[1] - density[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.slope * _squeeze(self.difference(rows)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _squeeze(difference: np.ndarray) -> np.ndarray:
    """Far tails of a Gaussian say little: large differences count by their root."""
    return np.sign(difference) * (np.sqrt(1 + np.abs(difference)) - 1)


def fit(labelled: DataFrame, label: str, shrinkage: float = SHRINKAGE, calibration_rows: int = CALIBRATION_ROWS) -> Discriminant | None:
    """Fits to rows with statistics and a 0/1 label; other labels are left out. None where a class has no row."""
    labelled = labelled.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), "doc_id", "statistics")
    d = len(STATISTICS)
    x = [F.col("statistics")[i] for i in range(d)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    by_class = {r["label"]: r for r in labelled.groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    if len(by_class) < 2:
        return None
    n = np.array([by_class[c]["n"] for c in (0, 1)], float)
    mean = np.array([[by_class[c][f"s{i}"] for i in range(d)] for c in (0, 1)]) / n[:, None]
    moment = np.array([[[by_class[c][f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)] for c in (0, 1)])
    covariance = moment / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = np.einsum("c,cij->ij", n / n.sum(), covariance + (mean - mean[1])[:, :, None] * (mean - mean[1])[:, None, :])
    centre, scale = mean[1], np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    means, factors, offsets = (mean - centre) / scale, [], []
    for c in (0, 1):
        s = covariance[c] / np.outer(scale, scale)
        s = (1 - shrinkage) * s + shrinkage * max(np.trace(s) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        offsets.append(-np.log(np.diag(lower)).sum())
    raw = Discriminant(centre, scale, means, np.array(factors), np.array(offsets))
    sample = labelled.where(hashed_share("doc_id", calibration_rows / n.sum())).toPandas()
    if sample.empty:
        return raw
    slope, intercept = _logistic(_squeeze(raw.difference(np.stack(sample["statistics"]))), sample["label"].to_numpy(float))
    return Discriminant(centre, scale, means, raw.factors, raw.offsets, slope, intercept)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one variable, by Newton's method."""
    a = np.column_stack([x, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w = w - np.linalg.solve(h, a.T @ (p - y) + ridge * w)
    return float(w[0]), float(w[1])


def score_column(model: Discriminant | None, statistics: Column) -> Column:
    """The probability of label 1; 0.5 for each row without a model."""

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(rows)) if len(rows) else [], dtype=float)

    return score(statistics) if model else F.lit(0.5)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: label 1 likelier), statistics.

    Learns from the labelled rows that aren't held out; only the text enters the statistics. A null text is empty; rows with
    a null id are scored, but never learnt from. Without labels of both classes each score is 0.5.
    """
    spark: SparkSession = docs.sparkSession
    found = with_statistics(docs.select("doc_id", "text")).select("doc_id", held_out().alias("held_out"), "statistics")
    found = written(found, f"{shared_folder(spark, 'quality')}/statistics")
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias(label))
    model = fit(found.where("not held_out").join(known, "doc_id"), label)
    return found.withColumn("score", score_column(model, F.col("statistics")))


#: A document is rejected below this score.
THRESHOLD = 0.3


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns; learns as quality_scores does."""
    name, score = "__statistics", "__score"
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # Written with their texts: the second pass needs no statistics of its own.
    found = written(with_statistics(docs, name), f"{shared_folder(docs.sparkSession, 'quality')}/statistics")
    learnt = found.where(~held_out()).select("doc_id", F.col(name).alias("statistics"))
    model = fit(learnt.join(known, "doc_id"), "quality")
    return found.withColumn(score, score_column(model, F.col(name))).where(F.col(score) >= threshold).drop(name, score)
