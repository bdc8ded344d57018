"""Token ids in files of wavelet matrices: one self-contained, compressed and indexed file per shard.

Documents are dealt out by ranges of their ids, so each task holds a stretch of the corpus in order. It encodes its texts and
closes a shard whenever enough ids have come together. A shard's ids lie in bit planes, highest bit first; below each plane
the ids with bit 0 go before those with bit 1, in their order. Each plane is cut into blocks, which are compressed one by
one, beside the number of one-bits before each. So single ids, counts of an id within a stretch and the place of its k-th
occurrence read a block or two per plane; whole shards are read plane by plane from the lowest.

File format, little-endian: magic, then counts (ids, documents, planes, bytes of the documents' lengths), per plane the border
between zeros and ones, per block the one-bits before it and its size, the documents' lengths, and the blocks.
The file is the payload of a row of a Parquet table, one file per shard: so Spark's committer publishes it once, whatever task
or executor is lost, and any store that Spark reads will do.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.packing import encoder
from vaultgauge.llm.shared import shared_folder, text_of

#: Closes each document.
END_ID = 2
#: A shard is closed by the document that reaches this many ids.
SHARD_IDS = 1 << 20
BLOCK_BITS = 1 << 15
#: Rows of a batch of results.
BATCH_ROWS = 10_000
MAGIC = b"WVM1"
_HEAD = struct.Struct("<4sQQII")


# ---- file ----

def built(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The file of a shard: its ids (unsigned 32-bit) and the end of each document among them."""
    n, planes = len(ids), max(1, int(ids.max(initial=0)).bit_length())
    per_plane = -(-n // BLOCK_BITS)
    borders = np.zeros(planes, "<u8")
    ones_before = np.zeros((planes, per_plane + 1), "<u8")
    sizes = np.zeros((planes, per_plane), "<u4")
    press, blocks = zstandard.ZstdCompressor(level=1), []
    left = ids.astype(np.uint16 if planes <= 16 else np.uint32)  # half as many bytes to move
    for plane in range(planes):
        is_one = (left & left.dtype.type(1 << (planes - 1 - plane))) != 0
        packed = np.packbits(is_one, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK_BITS // 8), dtype=np.int64) if n else np.zeros(0, np.int64)
        ones_before[plane, 1:] = np.cumsum(ones)
        packed = packed.tobytes()
        for block in range(per_plane):
            plain = packed[block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8]
            small = press.compress(plain)
            blocks.append(small if len(small) < len(plain) else plain)  # as long as the plain bits: stored as they are
            sizes[plane, block] = len(blocks[-1])
        left = np.concatenate([left[~is_one], left[is_one]])
        borders[plane] = n - int(ones.sum())
    directory = press.compress(np.diff(ends, prepend=0).astype("<u8").tobytes())
    head = _HEAD.pack(MAGIC, n, len(ends), planes, len(directory))
    return b"".join([head, borders.tobytes(), ones_before.tobytes(), sizes.tobytes(), directory, *blocks])


class Shard:
    """A file of a shard, opened: single blocks are decompressed when asked for and a few of them kept."""

    def __init__(self, data: bytes):
        magic, self.n, self.documents, self.planes, directory = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of this format")
        per_plane, at = -(-self.n // BLOCK_BITS), _HEAD.size

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found.astype(np.int64)

        self.borders = array("<u8", self.planes)
        self.ones_before = array("<u8", self.planes * (per_plane + 1)).reshape(self.planes, per_plane + 1)
        self.sizes = array("<u4", self.planes * per_plane).reshape(self.planes, per_plane)
        self._expand = zstandard.ZstdDecompressor()
        lengths = np.frombuffer(self._expand.decompress(data[at : at + directory]), "<u8") if self.documents else np.zeros(0)
        self.ends = np.cumsum(lengths.astype(np.int64))
        self._places = at + directory + np.concatenate([[0], np.cumsum(self.sizes.ravel())[:-1]]) if self.n else np.zeros(0)
        self._data = data
        self.block = functools.lru_cache(256)(self._block)

    def _packed(self, plane: int, block: int) -> bytes:
        size, at = int(self.sizes[plane, block]), int(self._places[plane * self.sizes.shape[1] + block])
        plain = -(-min(BLOCK_BITS, self.n - block * BLOCK_BITS) // 8)
        found = self._data[at : at + size]
        return found if size == plain else self._expand.decompress(found, max_output_size=plain)

    def _block(self, plane: int, block: int) -> np.ndarray:
        """One-bits before each place of a block, from its start."""
        bits = np.unpackbits(np.frombuffer(self._packed(plane, block), np.uint8), bitorder="little")
        return np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    def _ones(self, plane: int, place: int) -> int:
        """One-bits of a plane before a place."""
        block, within = divmod(place, BLOCK_BITS)
        before = int(self.ones_before[plane, block])
        return before + int(self.block(plane, block)[within]) if within else before

    def _step(self, plane: int, place: int, bit: int) -> int:
        ones = self._ones(plane, place)
        return int(self.borders[plane]) + ones if bit else place - ones

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for plane in range(self.planes):
            bit = self._ones(plane, place + 1) - self._ones(plane, place)
            value, place = value << 1 | bit, self._step(plane, place, bit)
        return value

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs at the places from start to end."""
        start, end = max(0, start), self.n if end is None else min(end, self.n)
        if token >> self.planes or start >= end:
            return 0
        for plane in range(self.planes):
            bit = token >> (self.planes - 1 - plane) & 1
            start, end = self._step(plane, start, bit), self._step(plane, end, bit)
        return end - start

    def select(self, token: int, k: int) -> int | None:
        """The place of the k-th occurrence (from 0) of an id; None where it has fewer."""
        if k < 0 or k >= self.count(token):
            return None
        first = 0
        for plane in range(self.planes):
            first = self._step(plane, first, token >> (self.planes - 1 - plane) & 1)
        place = first + k
        for plane in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - plane) & 1
            place = self._find(plane, bit, place - int(self.borders[plane]) if bit else place)
        return place

    def _find(self, plane: int, bit: int, k: int) -> int:
        """The place of the k-th bit (from 0) of a kind in a plane."""
        before = self.ones_before[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        block = int(np.searchsorted(before, k, "right")) - 1
        within = self.block(plane, block)
        if not bit:
            within = np.arange(len(within)) - within
        return block * BLOCK_BITS + int(np.searchsorted(within, k - int(before[block]), "right")) - 1

    def occurrences(self, token: int) -> list[int]:
        """All places of an id."""
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids (unsigned 32-bit): planes from the lowest up, each undoing the order that the next one has."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for plane in reversed(range(self.planes)):
            packed = b"".join(self._packed(plane, block) for block in range(self.sizes.shape[1]))
            is_one = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").view(bool)
            border, above = int(self.borders[plane]), np.empty(self.n, kind)
            above[~is_one] = values[:border]
            above[is_one] = values[border:] | kind(1 << (self.planes - 1 - plane))
            values = above
        return values.astype(np.uint32)


# ---- tables ----

#: A row per shard; stretch and start give the order of the shards, and payload is the file.
SHARDS = "stretch int, start bigint, n_ids bigint, doc_ids binary, payload binary"


def stretches(docs: DataFrame, count: int) -> DataFrame:
    """doc_id, text and the stretch (0 to count - 1) of each row, ascending with the id; rows without an id count as the lowest.

    The borders are quantiles of the ids, from a pass over that column. An id with many rows is a border more than once;
    its rows, whose order among each other is free, are then dealt over all the stretches that it spans.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    found = docs.agg(F.percentile_approx(key, shares, 100 * count)).first()[0] if count > 1 else None
    borders = np.array(found or [], np.int64)

    @F.arrow_udf("int")
    def stretch(keys: pa.Array, any_number: pa.Array) -> pa.Array:
        low, high = (np.searchsorted(borders, keys.to_numpy(), side) for side in ("left", "right"))
        span = np.where(high - low > 1, high - low + 1, 1)
        return pa.array((low + any_number.to_numpy() % span).astype(np.int32))

    return docs.withColumn("stretch", stretch(key, F.xxhash64(F.monotonically_increasing_id())))


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes the texts of docs, in ascending order of doc_id, into files below folder; returns the table of shards.

    The ids are those of the tokenizers library with the vocabulary at path, found by the encoder of packing, which keeps nothing
    between texts: a task's memory is its shard.

    One row and one file per shard, see SHARDS. Null text is empty; each document's ids are followed by end_id. Rows that
    repeat are written as often, next to each other; rows without an id come first. A document lies in one shard whole,
    however long. An empty table gives no shard.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = encoder(path), np.array([end_id], "<u4").tobytes()
        stretch, start = 0, 0
        parts, docs_in, size = [], [], 0

        def shard() -> pa.RecordBatch:
            nonlocal parts, docs_in, size, start
            ids = np.frombuffer(b"".join(parts), "<u4")
            ends = np.cumsum([len(p) // 4 for p in parts])
            numbers = pa.array(docs_in, pa.int64())
            names = zstandard.compress(np.packbits(numbers.is_null()).tobytes() + numbers.fill_null(0).to_numpy().astype("<i8").tobytes())
            row = [[stretch], [start], [len(ids)], [names], [built(ids, ends)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            start += len(ids)
            parts, docs_in, size = [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["stretch", "start", "n_ids", "doc_ids", "payload"]
            )

        for batch in batches:
            for doc, text, of in zip(*batch.columns, strict=True):
                of = of.as_py()
                if of != stretch:  # a task may hold more than one
                    if parts:
                        yield shard()
                    stretch, start = of, 0
                parts.append(known.encode(text.as_py()) + end)
                docs_in.append(doc.as_py())
                size += len(parts[-1]) // 4
                if size >= shard_ids:
                    yield shard()
        known.forget()
        if parts:
            yield shard()

    dealt = stretches(docs, count).repartitionById(count, F.col("stretch"))
    shards = dealt.sortWithinPartitions("stretch", "doc_id").mapInArrow(build, SHARDS)
    # The payload is compressed by its own format.
    shards.write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)
    return read_shards(spark, folder)


def read_shards(spark, folder: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(folder)


def document_ids(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (binary, little-endian unsigned 32-bit) from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stretch, start, names, payload in zip(*batch.columns, strict=True):
                shard = Shard(payload.as_py())
                ids, ends = shard.ids(), shard.ends
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                plain, nulls = zstandard.decompress(names.as_py()), -(-len(ends) // 8)
                missing = np.unpackbits(np.frombuffer(plain, np.uint8, nulls), count=len(ends)).view(bool)
                docs = pa.array(np.frombuffer(plain, "<i8", offset=nulls), pa.int64(), mask=missing)
                for a in range(0, len(ends), BATCH_ROWS):
                    b = min(a + BATCH_ROWS, len(ends))
                    within = ids[starts[a] : ends[b - 1]]
                    offsets = pa.py_buffer(np.append(starts[a:b], ends[b - 1]).astype(np.int64) * 4 - int(starts[a]) * 4)
                    binary = pa.Array.from_buffers(pa.large_binary(), b - a, [None, offsets, pa.py_buffer(within.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([stretch.as_py()] * (b - a), pa.int32()), docs[a:b], pa.array(starts[a:b] + start.as_py()),
                         pa.array(ends[a:b] - starts[a:b]), binary.cast(pa.binary())],
                        ["stretch", "doc_id", "within", "n_tokens", "ids"],
                    )

    documents = shards.select("stretch", "start", "doc_ids", "payload").mapInArrow(
        read, "stretch int, doc_id bigint, within bigint, n_tokens bigint, ids binary"
    )
    return documents.join(F.broadcast(stretch_starts(shards)), "stretch").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids"
    )


def stretch_starts(shards: DataFrame) -> DataFrame:
    """stretch, before: the ids of all stretches before it. A row per stretch, whose number is a parameter."""
    sizes = shards.groupBy("stretch").agg(F.sum("n_ids").alias("n"))
    return sizes.selectExpr("stretch", "sum(n) OVER (ORDER BY stretch) - n AS before")


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """token, n: how often each of the given ids occurs in the corpus, by rank queries on the files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                shard = Shard(payload.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return shards.select("payload").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def token_occurrences(shards: DataFrame, token: int) -> DataFrame:
    """place: where in the corpus an id occurs, by select queries on the files."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stretch, start, payload in zip(*batch.columns, strict=True):
                shard = Shard(payload.as_py())
                total = shard.count(token)
                for first in range(0, total, BATCH_ROWS):
                    found = [start.as_py() + shard.select(token, k) for k in range(first, min(first + BATCH_ROWS, total))]
                    yield pa.RecordBatch.from_arrays([pa.array([stretch.as_py()] * len(found), pa.int32()), pa.array(found)], ["stretch", "within"])

    found = shards.select("stretch", "start", "payload").mapInArrow(find, "stretch int, within bigint")
    return found.join(F.broadcast(stretch_starts(shards)), "stretch").select((F.col("before") + F.col("within")).alias("place"))


def token_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from files that are written below the shared folder."""
    shards = write_shards(docs, path, shared_folder(docs.sparkSession, "wavelet"))
    return document_ids(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
