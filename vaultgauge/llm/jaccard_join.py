"""Similarity join of documents on the Jaccard similarity of their five-word shingles, by chosen paths.

Documents with the same set of shingles are one class. Each class has a MinHash signature; its tokens are the pairs of
coordinate and value. In a run, a bucket of classes is split by sampled coordinates: each coordinate is chosen with
probability 1 / (threshold * coordinates), depending on the bucket's path only, and classes go on to the bucket of each
chosen token, so that classes which share a token meet again. Buckets of one class end there; small buckets are compared
by brute force, first by signature, then exactly. A pair at the threshold survives a level with the chance of a critical
branching process, so runs are repeated, longer for classes whose buckets lie deeper, until the target recall is met.

Each pair is compared in one bucket only, the least of those that both classes have reached: links can be counted and
linked without being listed, so that a group of n near copies never becomes n * n rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.llm.bpe import Kept
from vaultgauge.llm.components import components
from vaultgauge.llm.shared import give_back, giving_back, shared_folder, text_of, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
COORDINATES = 64
#: Classes in a bucket that are compared with each other; larger ones are split. Two million comparisons of signatures take a
#: fraction of a second, and each level of splitting costs recall.
BUCKET = 2000
#: Depth at which a bucket that is still larger is compared in blocks, whatever its size.
DEPTH = 12
#: Chance that a pair at the threshold itself is found; pairs above are found more surely.
TARGET_RECALL = 0.999
RUNS_AT_ONCE = 12
#: Standard deviations below the threshold at which a signature no longer counts as a candidate.
SLACK = 4.0

_U64 = np.uint64
_STEP = _U64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a finaliser of multiplications and shifts)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


@functools.cache
def _constants() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        places = _mix(np.arange(1, SHINGLE_WORDS + 1, dtype=_U64) * _STEP) | _U64(1)
        factors = _mix(np.arange(101, 101 + COORDINATES, dtype=_U64) * _STEP) | _U64(1)
    return places, factors


def word_hashes() -> Kept:
    """Hashes of words. One per task, so that its memory goes with the task."""
    return Kept(xxhash.xxh64_intdigest, 200_000)


def shingles(text: str, hashes: Kept) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words in lower case; fewer words are one run, no words none."""
    places, _ = _constants()
    words = text.lower().split()
    if not words:
        return np.empty(0, _U64)
    h = np.fromiter(map(hashes.__getitem__, words), _U64, len(words))
    n = max(1, len(h) - SHINGLE_WORDS + 1)
    runs = np.zeros(n, _U64)
    with np.errstate(over="ignore"):
        for i in range(min(SHINGLE_WORDS, len(h))):
            runs += h[i : i + n] * places[i]
    return np.unique(_mix(runs))


def signature(hashes: np.ndarray) -> np.ndarray:
    _, factors = _constants()
    least = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 4096):
            values = _mix(hashes[i : i + 4096, None] * factors) >> _U64(32)
            least = np.minimum(least, values.min(0).astype(np.uint32))
    return least


def digest_of(hashes: np.ndarray) -> bytes:
    """Stands for the set of shingles: 128 bits."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def class_digest(text: Column) -> Column:
    @F.arrow_udf(T.BinaryType())
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = word_hashes()
        for texts in batches:
            yield pa.array([digest_of(shingles(t.as_py(), hashes)) for t in texts], pa.binary())
        hashes.forget()
        give_back()

    return digest(text)


def _signatures(docs: DataFrame) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for b in batches:
            digests, sizes, signatures = [], [], []
            for text in b.column(1):  # one by one: neither texts nor sets of a batch are held together
                s = shingles(text.as_py(), hashes)
                digests.append(digest_of(s))
                sizes.append(len(s))
                signatures.append(signature(s).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
                ["doc_id", "digest", "size", "signature"],
            )

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(giving_back(sign), f"doc_id {id_type}, digest binary, size bigint, signature binary")


def survival(depth: int) -> float:
    """Chance that a pair at the threshold is still together after so many levels: on average one shared token is chosen in each."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def runs_for(depth: int, recall: float = TARGET_RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """Splits buckets: rows with node, digest and signature give the same classes at each token chosen for their node."""
    limit = _U64(int(2**64 / (threshold * COORDINATES)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates = np.arange(1, COORDINATES + 1, dtype=_U64) * _STEP
        for b in batches:
            if not b.num_rows:
                continue
            node = b.column(0).to_numpy(zero_copy_only=False).view(_U64)
            values = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            path = _mix(node[:, None] ^ coordinates)
            row, chosen = np.nonzero(_mix(path) < limit)
            with np.errstate(over="ignore"):
                child = _mix(path[row, chosen] + values[row, chosen].astype(_U64) * _STEP)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), b.column(1).take(pa.array(row))], ["node", "digest"])

    return rows.select("node", "digest", "signature").mapInArrow(giving_back(split), "node bigint, digest binary")


def _leaves(classes: DataFrame, runs: range, folder: str, threshold: float, bucket: int, max_depth: int) -> DataFrame:
    """leaf, digest, members, depth: the buckets in which these runs end, those of a single class left out."""
    roots = [int(x) for x in _mix(np.array([r + 1 for r in runs], _U64) * _STEP).view(np.int64)]
    nodes = _children(classes.withColumn("node", F.explode(F.array(*map(F.lit, roots)))), threshold)
    found = []
    for depth in range(1, max_depth + 1):
        nodes = written(nodes, f"{folder}/nodes-{depth}")
        sizes = nodes.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        sized = written(nodes.join(sizes, "node"), f"{folder}/sized-{depth}")
        last = depth == max_depth
        found.append((sized if last else sized.where(F.col("members") <= bucket)).withColumn("depth", F.lit(depth)))
        large = sized.where(F.col("members") > bucket)
        if last or large.isEmpty():
            break
        nodes = _children(large.join(classes, "digest"), threshold)
    return functools.reduce(DataFrame.union, found).withColumnRenamed("node", "leaf")


def _groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Consecutive rows with the same first column, one table each."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        values = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), b.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            part = b.slice(start, end - start)
            if held and held[0].column(key)[0].as_py() != part.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _candidates(leaves: DataFrame, classes: DataFrame, threshold: float, bucket: int) -> DataFrame:
    """piece, place, digest, partners: of each bucket the classes with a likely link there, and the places of those linked after it.

    A bucket that is larger than allowed is compared in pieces of two blocks.
    """
    blocks = F.ceil(F.col("members") / bucket).cast("int")
    block = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = leaves.select("leaf", "digest", block.alias("block"), other.alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select(F.xxhash64("leaf", low, high).alias("piece"), "leaf", "digest", "block", (low == high).alias("within"))
    reached = leaves.groupBy("digest").agg(F.sort_array(F.collect_set("leaf")).alias("reached"))  # a few a run
    rows = rows.join(classes.join(reached, "digest"), "digest")
    least_equal = math.floor(COORDINATES * (threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            n = group.num_rows
            leaf, within = group["leaf"][0].as_py(), group["within"][0].as_py()
            sizes, block = group["size"].to_numpy(), group["block"].to_numpy()
            values = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint32).reshape(n, COORDINATES)
            reached = [set(x) for x in group["reached"].to_pylist()]
            partners: list[np.ndarray] = [np.empty(0, np.int32)] * n
            used = np.zeros(n, bool)
            for i in range(n - 1):
                likely = (values[i + 1 :] == values[i]).sum(1) >= least_equal
                likely &= np.minimum(sizes[i + 1 :], sizes[i]) >= threshold * np.maximum(sizes[i + 1 :], sizes[i])
                if not within:
                    likely &= block[i + 1 :] != block[i]
                here = [j for j in (np.flatnonzero(likely) + i + 1).tolist() if min(reached[i] & reached[j]) == leaf]
                if here:
                    partners[i] = np.array(here, np.int32)
                    used[i] = True
                    used[here] = True
            if used.any():
                keep = np.flatnonzero(used)
                yield pa.RecordBatch.from_arrays(
                    [group["piece"].combine_chunks().take(pa.array(keep)), pa.array(keep.astype(np.int32)),
                     group["digest"].combine_chunks().take(pa.array(keep)), pa.array([partners[k] for k in keep], pa.list_(pa.int32()))],
                    ["piece", "place", "digest", "partners"],
                )

    rows = rows.select("piece", "leaf", "within", "block", "digest", "size", "signature", "reached")
    rows = rows.repartition("piece").sortWithinPartitions("piece", "digest")
    return rows.mapInArrow(giving_back(compare), "piece bigint, place int, digest binary, partners array<int>")


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets; bit sets over what occurs more than once, if there are many pairs."""
    if len(pairs) < 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs.tolist()])
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared = values[counts > 1]
    overlap = np.zeros(len(pairs), np.int64)
    for start in range(0, len(shared), 1 << 15):  # bounds the memory of the bit sets
        part = shared[start : start + (1 << 15)]
        bits = np.zeros((len(sets), -(-len(part) // 64) * 64), bool)
        for i, s in enumerate(sets):
            s = s[(s >= part[0]) & (s <= part[-1])]
            at = np.searchsorted(part, s)
            bits[i, at[part[np.minimum(at, len(part) - 1)] == s]] = True
        packed = np.packbits(bits, axis=1).view(_U64)
        for k in range(0, len(pairs), 4096):
            i, j = pairs[k : k + 4096].T
            overlap[k : k + 4096] += np.bitwise_count(packed[i] & packed[j]).sum(1, dtype=np.int64)
    return overlap


def _verified(group: pa.Table, threshold: float) -> tuple[list[bytes], np.ndarray]:
    """The classes of a piece, and the pairs of them that are at the threshold or above, exactly."""
    place = group["place"].to_numpy()  # in order
    hashes = word_hashes()
    sets = [shingles(t, hashes) for t in group["text"].to_pylist()]
    partners = group["partners"].combine_chunks()
    first = np.repeat(np.arange(len(sets)), partners.value_lengths().to_numpy(zero_copy_only=False))
    second = np.searchsorted(place, partners.flatten().to_numpy(zero_copy_only=False))
    pairs = np.column_stack([first, second]).astype(np.int64)
    if len(pairs):
        sizes = np.array([len(s) for s in sets])
        overlap = _overlaps(sets, pairs)
        pairs = pairs[overlap >= threshold * (sizes[pairs].sum(1) - overlap) - 1e-9]
    return group["digest"].to_pylist(), pairs


def _links(pieces: DataFrame, threshold: float) -> DataFrame:
    """digest, links, root: of each class in each piece the number of its links there, and a class that it hangs together with."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            digests, pairs = _verified(group, threshold)
            if not len(pairs):
                continue
            links = np.bincount(pairs.ravel(), minlength=len(digests))
            root = list(range(len(digests)))

            def top(i: int) -> int:
                while root[i] != i:  # noqa: B023
                    root[i] = root[root[i]]  # noqa: B023
                    i = root[i]  # noqa: B023
                return i

            for i, j in pairs:
                a, b = top(int(i)), top(int(j))
                root[max(a, b)] = min(a, b)
            keep = np.flatnonzero(links).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[k] for k in keep], pa.binary()), pa.array(links[keep].astype(np.int64)), pa.array([digests[top(k)] for k in keep], pa.binary())],
                ["digest", "links", "root"],
            )

    return pieces.mapInArrow(giving_back(verify), "digest binary, links bigint, root binary")


def _pairs(pieces: DataFrame, threshold: float) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            digests, pairs = _verified(group, threshold)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array([digests[k] for k in pairs[:, c]], pa.binary()) for c in (0, 1)], ["a", "b"])

    return pieces.mapInArrow(giving_back(verify), "a binary, b binary")


class Join:
    """The join of one table with itself: its parts are tables in the shared folder."""

    def __init__(
        self, docs: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, max_depth: int = DEPTH,
        recall: float = TARGET_RECALL, runs_at_once: int = RUNS_AT_ONCE,
    ):
        self.folder, self.threshold = shared_folder(docs.sparkSession, "jaccard-join"), threshold
        self.rows = written(_signatures(docs), f"{self.folder}/rows")
        #: digest, class_id, class_size, size, signature: documents with the same shingles are one class.
        self.classes = written(
            self.rows.groupBy("digest").agg(
                F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min("size").alias("size"), F.min("signature").alias("signature")
            ),
            f"{self.folder}/classes",
        )
        signed = self.classes.where("size > 0").select("digest", "size", "signature")
        active, done, leaves = signed, 0, []
        while True:
            runs = range(done, done + runs_at_once)
            leaves.append(_leaves(active, runs, f"{self.folder}/runs-{done}", threshold, bucket, max_depth))
            done += runs_at_once
            short = [d for d in range(1, max_depth + 1) if runs_for(d, recall) > done]
            if not short:
                break
            deep = functools.reduce(DataFrame.union, leaves).where(F.col("depth") >= short[0]).select("digest").distinct()
            if deep.isEmpty():
                break
            active = written(signed.join(deep, "digest", "left_semi"), f"{self.folder}/active-{done}")
        self.runs = done
        leaves = functools.reduce(DataFrame.union, leaves)
        candidates = written(_candidates(leaves, signed, threshold, bucket), f"{self.folder}/candidates")
        wanted = candidates.select("digest").distinct().join(self.classes.select("digest", "class_id"), "digest")
        texts = docs.select("doc_id", text_of().alias("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("class_id")))
        texts = texts.where(class_digest(F.col("text")) == F.col("digest"))  # an id may have several texts
        texts = texts.select("digest", "text").dropDuplicates(["digest"])
        self.pieces = candidates.join(texts, "digest").select("piece", "place", "digest", "partners", "text").repartition("piece").sortWithinPartitions("piece", "place")

    def pairs(self) -> DataFrame:
        """a, b: class_ids of each two classes at the threshold or above, once."""
        name = lambda side: self.classes.select(F.col("digest").alias(side), F.col("class_id").alias(f"{side}_id"))
        found = _pairs(self.pieces, self.threshold).join(name("a"), "a").join(name("b"), "b")
        return found.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))

    def grouped(self) -> DataFrame:
        """digest, class_id, class_size, n_links, group_id of each class; group_id is the smallest class_id of those linked over any number of links."""
        links = written(_links(self.pieces, self.threshold), f"{self.folder}/links")
        counts = links.groupBy("digest").agg(F.sum("links").alias("n_links"))
        roots = components(links.select(F.col("digest").alias("a"), F.col("root").alias("b")), f"{self.folder}/components")
        named = roots.join(self.classes.select(F.col("digest").alias("node"), "class_id"), "node")
        groups = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
        members = roots.join(groups, "root").select(F.col("node").alias("digest"), "group_id")
        return (
            self.classes.select("digest", "class_id", "class_size")
            .join(counts, "digest", "left")
            .join(members, "digest", "left")
            .withColumns({"n_links": F.coalesce("n_links", F.lit(0).cast("bigint")), "group_id": F.coalesce("group_id", "class_id")})
        )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: doc_id, class_id, class_size, n_links, group_id.

    class_id is the smallest doc_id with the same shingles, class_size the number of such rows, n_links the number of other
    classes at the threshold or above, group_id the smallest doc_id of the near duplicates, over any number of links. Texts
    without words are one class without links; null text is empty, and a null id belongs to its class, but names none unless
    it has no other. Rows that repeat count as often.
    """
    join = Join(docs, **options)
    return join.rows.select("doc_id", "digest").join(join.grouped(), "digest").select("doc_id", "class_id", "class_size", "n_links", "group_id")


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each group of near duplicates that of the smallest doc_id."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    grouped = Join(docs, **options).grouped().where(F.col("class_id").eqNullSafe(F.col("group_id")))
    kept = grouped.select(F.col("digest").alias("__digest"), name("class_id").alias("__id"))
    return (
        docs.withColumns({"__digest": class_digest(text_of()), "__id": name("doc_id")})
        .join(kept, ["__digest", "__id"], "left_semi")
        .dropDuplicates(["__digest", "__id"])
        .select(*docs.columns)
    )
