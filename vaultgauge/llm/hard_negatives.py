"""Hard negatives of anchors by a vertical scan with bounds (BOND).

Rows are kept in blocks, dimension by dimension, with the least and the greatest component of each. An anchor reads a block's
dimensions in descending order of its own components' magnitude. After each few of them, what the remaining dimensions can
add at least and at most narrows every row's score to an interval; rows that can no longer enter any of the anchor's lists leave the
bitmap of candidates. The scores of those that stay to the end are exact, and decide.

Anchors are taken in rounds of a fixed number. A round's anchors go to all tasks, which scan their blocks one after another
and carry each anchor's best rows along, so that later blocks are pruned by earlier ones. Two scans a round: the first
finds the positives, whose scores are the windows of the second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultgauge.llm.shared import shared_folder, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score between which a negative's lies.
LEAST, MOST = 30, 90
#: Rows of a block, and anchors of a round. Both bound memory only.
BLOCK_ROWS = 4096
ROUND_ANCHORS = 2048
#: Dimensions read before the candidates are looked at: half of them first, then an eighth each time.
FIRST_SHARE, NEXT_SHARE = 2, 8
#: Below so many candidates the rest of the dimensions is read at once.
FEW = 48

BLOCKS = "vec_ids binary, labels binary, first_row bigint, kind string, columns array<binary>, least binary, most binary"


def usable(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector: rows with an id, a label and finite components only, each component floor(scale * x)."""
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    able = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    return able.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))


def blocks(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows, dimension by dimension: a row per block, see BLOCKS. Each task cuts the rows that it reads.

    Shorter vectors are filled up with zeros. Integers are as narrow as the block's components allow.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                vectors = part.column(2)
                lengths = np.diff(vectors.offsets.to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                dims = int(lengths.max(initial=0))
                rows = np.zeros((part.num_rows, dims), np.int64)
                rows[np.arange(dims)[None, :] < lengths[:, None]] = flat
                largest = max(int(rows.max(initial=0)), -int(rows.min(initial=0)))
                kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
                columns = [np.ascontiguousarray(rows[:, j]).astype(kind).tobytes() for j in range(dims)]
                row = [
                    part.column(0).to_numpy().astype("<i8").tobytes(), part.column(1).to_numpy().astype("<i8").tobytes(), part.column(3)[0].as_py(),
                    kind, columns, rows.min(axis=0).astype("<i8").tobytes(), rows.max(axis=0).astype("<i8").tobytes(),
                ]
                kinds = [pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
                names = ["vec_ids", "labels", "first_row", "kind", "columns", "least", "most"]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    # Within a task the numbers follow each other, so a block needs that of its first row only.
    numbered = vectors.select("vec_id", "label", "vector", F.monotonically_increasing_id().alias("row_no"))
    return numbered.mapInArrow(cut, BLOCKS)


class Best:
    """The best rows of one list: scores between two limits, higher first, of equals the smaller vec_id."""

    def __init__(self, least: int | None, most: int | None, size: int):
        self.least, self.most, self.size = least, most, size
        self.rows = np.empty((0, 3), np.int64)  # score, vec_id, row_no

    @property
    def bar(self) -> int | None:
        """A row with a lower score can't enter; None where any can."""
        if len(self.rows) < self.size:
            return self.least
        return int(self.rows[-1, 0])

    def take(self, scores: np.ndarray, vec_ids: np.ndarray, row_nos: np.ndarray) -> None:
        fits = np.ones(len(scores), bool) if self.bar is None else scores >= self.bar
        if self.most is not None:
            fits &= scores <= self.most
        if fits.any():
            rows = np.concatenate([self.rows, np.stack([scores[fits], vec_ids[fits], row_nos[fits]], axis=1)])
            self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))][: self.size]


class Block:
    """A block, its columns as numbers in which all sums are exact."""

    def __init__(self, row: dict):
        self.vec_ids = np.frombuffer(row["vec_ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.row_nos = row["first_row"] + np.arange(len(self.vec_ids))
        self.least, self.most = np.frombuffer(row["least"], "<i8"), np.frombuffer(row["most"], "<i8")
        self.columns = np.array([np.frombuffer(c, row["kind"]) for c in row["columns"]]).reshape(len(self.least), len(self.vec_ids))
        self.largest = max([int(self.most.max(initial=0)), -int(self.least.min(initial=0))])
        self.as_kind: dict[type, np.ndarray] = {}

    def exact(self, query: np.ndarray) -> np.ndarray:
        """The columns in the fastest kind of number that holds every sum with this query."""
        bound = sum(map(abs, query.tolist())) * self.largest
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
        if kind not in self.as_kind:
            self.as_kind[kind] = self.columns.astype(kind)
        return self.as_kind[kind]

    def search(self, query: np.ndarray, candidates: np.ndarray, lists: list[Best]) -> None:
        """Offers the candidates (a bitmap) to the lists, as far as the bounds leave them in play."""
        dims = min(len(query), len(self.columns))
        query = query[:dims]
        columns = self.exact(query)
        kind = columns.dtype
        order = np.argsort(-np.abs(query), kind="stable")
        asked = query[order].astype(kind)
        ends = np.stack([query * self.least[:dims], query * self.most[:dims]])[:, order] if kind != object else None
        if ends is None:
            ends = np.array([[q * int(m[j]) for q, j in zip(query.tolist(), range(dims), strict=True)] for m in (self.least, self.most)], object)[:, order]
        # What the dimensions from each on can add at least and at most.
        rest_least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0) if dims else np.zeros(1, np.int64)
        rest_most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0) if dims else np.zeros(1, np.int64)
        left = np.flatnonzero(candidates)
        sums = np.zeros(len(left), kind)
        whole, done = len(left) == len(candidates), 0
        while done < dims and len(left):
            step = dims - done if len(left) < FEW else -(-dims // (FIRST_SHARE if not done else NEXT_SHARE))
            now = order[done : done + step]
            part = columns[now] if whole else columns[now[:, None], left]
            sums = sums + asked[done : done + len(now)] @ part
            done += len(now)
            if done < dims:
                stays = self._in_play(sums, int(rest_least[done]), int(rest_most[done]), lists)
                if not stays.all():
                    left, sums, whole = left[stays], sums[stays], False
        if len(left):
            scores = sums.astype(np.int64) if kind != object else np.array([int(s) for s in sums], np.int64)
            for best in lists:
                best.take(scores, self.vec_ids[left], self.row_nos[left])

    @staticmethod
    def _in_play(sums: np.ndarray, least: int, most: int, lists: list[Best]) -> np.ndarray:
        """Rows whose score, between sums + least and sums + most, may still enter a list."""
        stays = np.zeros(len(sums), bool)
        for best in lists:
            may = np.ones(len(sums), bool) if best.most is None else sums <= best.most - least
            bar = best.bar
            # Rows that are in the limits for certain raise the bar by their least scores.
            sure = sums if best.most is None else sums[sums <= best.most - most]
            if best.least is not None:
                sure = sure[sure >= best.least - least]
            if len(sure) >= best.size:
                raised = int(np.partition(sure, len(sure) - best.size)[len(sure) - best.size]) + least
                bar = raised if bar is None else max(bar, raised)
            if bar is not None:
                may &= sums >= bar - most
            stays |= may
        return stays


def _found(blocks: DataFrame, lists_of: list[tuple[np.ndarray, int, int, list[tuple]]], same_label: bool) -> DataFrame:
    """anchor, list, score, vec_id, row_no: the best rows of each list of each anchor.

    lists_of: per anchor its vector, label, row number, and (least, most, size) of each of its lists. Candidates are the other rows
    of its label, or those of other labels. Each task gives out its own best rows; the best of those are the best.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[Best(*limits) for limits in limits_of] for *_, limits_of in lists_of]
        for batch in batches:
            for number in range(batch.num_rows):
                block = Block({name: batch.column(name)[number].as_py() for name in batch.schema.names})
                of_label: dict[int, np.ndarray] = {}
                for (query, label, row_no, limits_of), lists in zip(lists_of, best, strict=True):
                    if not limits_of:
                        continue
                    if label not in of_label:
                        of_label[label] = (block.labels == label) == same_label
                    candidates = of_label[label]
                    place = row_no - int(block.row_nos[0])
                    if same_label and 0 <= place < len(candidates):
                        candidates = candidates.copy()
                        candidates[place] = False
                    block.search(query, candidates, lists)
        for anchor, lists in enumerate(best):
            for number, one in enumerate(lists):
                if len(one.rows):
                    same = [pa.array(np.full(len(one.rows), x, np.int32)) for x in (anchor, number)]
                    rows = [pa.array(one.rows[:, i]) for i in range(3)]
                    yield pa.RecordBatch.from_arrays([*same, *rows], ["anchor", "list", "score", "vec_id", "row_no"])

    found = blocks.mapInArrow(scan, "anchor int, list int, score bigint, vec_id bigint, row_no bigint")
    in_order = Window.partitionBy("anchor", "list").orderBy(F.col("score").desc(), "vec_id", "row_no")
    sizes = max((size for *_, limits_of in lists_of for *_, size in limits_of), default=0)
    return found.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= sizes)


def mined(
    embeddings: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
    round_anchors: int = ROUND_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of each anchor and positive.

    embeddings: vec_id, label, embedding. Rows with a null id, label or vector, or a component that is null or not finite, take
    no part. Anchors are the rows whose vec_id is divisible by every; a score is the integer inner product of floor(scale * x).
    An anchor's positives are its best other rows of its label, all where it has fewer; of each, the best rows of other labels with
    least * p <= 100 * n <= most * p are given, ranked from 1. Higher scores are better, of equals the smaller vec_id.
    A shorter vector counts as filled up with zeros; an empty one scores 0 with all. Rows that repeat take part one by one, as
    anchors too. Scores beyond 64 bits are an error. Other columns are left out. An empty table gives no rows.
    """
    spark, folder = embeddings.sparkSession, shared_folder(embeddings.sparkSession, "negatives")
    vectors = usable(embeddings, scale)
    stored = written(blocks(vectors), f"{folder}/blocks")
    # Anchors with the numbers that their rows have in the blocks.
    rows = stored.select("first_row", "vec_ids", "labels", "kind", "columns").mapInArrow(_rows_of(every), _ANCHORS)
    anchors = written(rows, f"{folder}/anchors")
    rounds = -(-anchors.count() // round_anchors)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not rounds:
        return spark.createDataFrame([], schema)
    for number in range(rounds):
        some = anchors.where(F.pmod(F.xxhash64("row_no"), F.lit(rounds)) == number).collect()  # about round_anchors of them
        queries = [(np.array(a.vector, np.int64), a.label, a.row_no) for a in some]
        best = _found(stored, [(*q, [(None, None, positives)]) for q in queries], same_label=True).collect()
        windows: list[list[tuple]] = [[] for _ in some]
        of_windows: list[list[tuple]] = [[] for _ in some]  # positive's id and score, and its window
        for r in sorted(best, key=lambda r: (r.anchor, r.place)):
            # Whole scores between least and most percent of the positive's.
            window = (-(-least * r.score // 100), most * r.score // 100, negatives)
            if window[0] <= window[1]:
                if window not in windows[r.anchor]:
                    windows[r.anchor].append(window)
                of_windows[r.anchor].append((r.vec_id, r.score, windows[r.anchor].index(window)))
        found = _found(stored, [(*q, w) for q, w in zip(queries, windows, strict=True)], same_label=False)
        given = [(n, a.vec_id, p, s, w) for n, (a, ps) in enumerate(zip(some, of_windows, strict=True)) for p, s, w in ps]
        lists = spark.createDataFrame(given, "anchor int, anchor_id bigint, positive_id bigint, positive_score bigint, list int")
        # A row per anchor of the round and positive.
        result = found.join(F.broadcast(lists), ["anchor", "list"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        result.write.mode("overwrite").parquet(f"{folder}/found/round={number}")
    return spark.read.schema(schema).option("basePath", f"{folder}/found").parquet(f"{folder}/found").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


_ANCHORS = "vec_id bigint, label bigint, row_no bigint, vector array<bigint>"


def _rows_of(every: int):
    """Reads the rows whose vec_id is divisible by every back from blocks."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                first, vec_ids, labels, kind, columns = (v.as_py() for v in values)
                vec_ids = np.frombuffer(vec_ids, "<i8")
                at = np.flatnonzero(vec_ids % every == 0)
                if len(at):
                    table = np.array([np.frombuffer(c, kind)[at] for c in columns], np.int64).reshape(len(columns), len(at))
                    vectors = pa.array(list(table.T), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(vec_ids[at]), pa.array(np.frombuffer(labels, "<i8")[at]), pa.array(first + at), vectors],
                        ["vec_id", "label", "row_no", "vector"],
                    )

    return rows_of


def relabelled(embeddings: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The rows whose vec_id is divisible by every move on to the next label."""
    moves = F.col("vec_id") % every == 0
    return embeddings.withColumn("label", F.when(moves, (F.col("label") + 1) % labels).otherwise(F.col("label")))
