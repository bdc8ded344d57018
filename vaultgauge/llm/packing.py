"""Packing of documents into sequences of a fixed size, online, by the sum of squares.

Each task packs the documents of its partition while it reads them: nothing is shuffled, and tasks share nothing. A document's
whole windows go out as they are; what remains goes to that fill level which leaves the smallest sum of squared counts of
partially filled windows by level (a new window counts as level 0; of equals the fullest). The counts lie in an array by
level. At the end of a partition the windows that are still open are filled up with pieces of the emptiest ones; the last
one is cut into powers of two. So no sequence needs padding.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.bpe import PIECES, Encoder, Vocabulary
from vaultgauge.llm.shared import giving_back, text_of

SIZE = 2048
#: Closes each document.
END_ID = 1
#: Bytes of ids in partially filled windows that a task holds; beyond, they are filled up as at the end, so placement starts anew
#: there. Bounds memory: a task packs some 16,000 half-filled windows of the default size together.
OPEN_BYTES = 64 << 20
#: PIECES for texts that are cut before the last character of each run of white space.
CUT_PIECES = PIECES.replace(r"\s+(?!\S)|", "")
#: Runs of white space: what Unicode calls so, as the pattern above; Python's own class has four separators more.
RUNS = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}"
#: Bytes of ids in a batch of results.
BATCH_BYTES = 4 << 20


class FastEncoder(Encoder):
    """The same ids as Encoder, by the tiktoken library: the method of this operator isn't encoding. It needs the tokens, no merges.

    Of white space in a row, the last character goes with what follows. The library finds that by looking ahead, at every place of
    a text; here texts are cut before that character instead, so the rest of the pattern needs no look ahead and is matched several
    times as fast. Nothing is kept from one text to the next.
    """

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path, with_merges=False)
        ranks = tiktoken.Encoding("bpe", pat_str=CUT_PIECES, mergeable_ranks=self.vocabulary.ids, special_tokens={})
        self.encode_ordinary = ranks.encode_ordinary
        self.runs = re.compile(RUNS)

    def forget(self) -> None:
        """Nothing is kept."""

    def _text_ids(self, text: str) -> bytes:
        ids, start = [], 0
        for run in self.runs.finditer(text):
            if run.end() < len(text):
                ids += self.encode_ordinary(text[start : run.end() - 1])
                start = run.end() - 1
        ids += self.encode_ordinary(text[start:] if start else text)
        return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> FastEncoder:
    return FastEncoder(path)


class Packer:
    """Packs the documents of one partition. Rows: doc, start, length, ids, doc_tokens, sequence number, offset."""

    def __init__(self, size: int = SIZE, open_bytes: int = OPEN_BYTES):
        self.size, self.open_bytes = size, open_bytes
        self.counts = np.zeros(size + 1, np.int64)  # windows by fill level; full ones aren't counted
        self.at_level: list[list[list[tuple]]] = [[] for _ in range(size)]
        self.sequences = 0
        self.held = 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """Takes a document; yields the rows of windows that are full."""
        total, size = len(ids) // 4, self.size
        rest = total % size
        for start in range(0, total - rest, size):
            yield from self._emit([(doc, start, ids[4 * start : 4 * (start + size)], total)])
        if rest:
            yield from self._place((doc, total - rest, ids[4 * (total - rest) :], total), rest)
            if self.held > self.open_bytes:
                yield from self.close()

    def level_for(self, length: int) -> int:
        """The level whose window takes a piece: it leaves the smallest sum of squared counts. 0: a new window."""
        at, after = self.counts[1 : self.size - length + 1], self.counts[1 + length :]
        change = 2 * (after - at) + 2
        if len(change):
            change[-1] -= 1  # a full window leaves the counts
            change = np.where(at > 0, change, np.iinfo(np.int64).max)
            best = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
            if change[best] <= 2 * self.counts[length] + 1:
                return best + 1
        return 0

    def _place(self, piece: tuple, length: int) -> Iterator[tuple]:
        level = self.level_for(length)
        if level:
            window = self.at_level[level].pop()
            self.counts[level] -= 1
            self.held -= 4 * level
        else:
            window = []
        window.append(piece)
        if level + length == self.size:
            yield from self._emit(window)
        else:
            self.at_level[level + length].append(window)
            self.counts[level + length] += 1
            self.held += 4 * (level + length)

    def close(self) -> Iterator[tuple]:
        """Fills the open windows with pieces of the emptiest, and cuts the last one into powers of two."""
        windows = [w for level in range(self.size - 1, 0, -1) for w in self.at_level[level]]
        self.at_level, self.held = [[] for _ in range(self.size)], 0
        self.counts[:] = 0
        first, spare = 0, []
        while first < len(windows) or spare:
            window = windows[first] if first < len(windows) else []
            first += 1
            gap = self.size - sum(len(p[2]) // 4 for p in window)
            while gap:
                if not spare:
                    if first >= len(windows):
                        break
                    spare = windows.pop()
                doc, start, ids, total = spare.pop()
                window.append((doc, start, ids[: 4 * gap], total))
                if len(ids) > 4 * gap:
                    spare.append((doc, start + gap, ids[4 * gap :], total))
                gap -= len(window[-1][2]) // 4
            yield from self._emit(window) if not gap else self._powers(window)

    def _powers(self, window: list[tuple]) -> Iterator[tuple]:
        pieces = window[::-1]
        while pieces:
            room = 1 << ((sum(len(p[2]) for p in pieces) // 4).bit_length() - 1)
            part = []
            while room:
                doc, start, ids, total = pieces.pop()
                part.append((doc, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    pieces.append((doc, start + room, ids[4 * room :], total))
                room -= len(part[-1][2]) // 4
            yield from self._emit(part)

    def _emit(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in window:
            yield doc, start, len(ids) // 4, ids, total, self.sequences, offset
            offset += len(ids) // 4
        self.sequences += 1


def packed(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is the ids of its whole text by the vocabulary at path, then end_id; null text is empty, so each row has one
    id at least. Each id lies in exactly one piece; the pieces of a sequence follow each other without gaps. Sequences have size ids,
    or a lower power of two. Rows that repeat are packed as often; an empty table gives none. Sequence ids are unique, not dense:
    the partition's number and a count. A partition is always packed alike, so a task that is run again gives the same rows.
    """
    doc_type = docs.schema["doc_id"].dataType
    name = doc_type.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = encoder(path), Packer(size)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            doc, start, length, ids, total, sequence, offset = zip(*rows, strict=True)
            sequence = np.array(sequence, np.int64) + base
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, arrow_type), *(pa.array(x, pa.int64()) for x in (start, length)), pa.array(ids, pa.binary()),
                 *(pa.array(x, pa.int64()) for x in (total, sequence, offset))],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        held, arrow_type = 0, pa.int64()

        def results():
            for b in batches:
                nonlocal arrow_type
                arrow_type = b.schema.field(0).type
                for doc, text in zip(b.column(0), b.column(1), strict=True):  # one by one: a batch of texts isn't held twice
                    yield from packer.add(doc.as_py(), known.encode(text.as_py()) + end)
            known.forget()
            yield from packer.close()

        for row in results():
            rows.append(row)
            held += len(row[3]) + 100
            if held > BATCH_BYTES:
                yield batch()
                held = 0
        if rows:
            yield batch()

    schema = f"doc_id {name}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(giving_back(pack), schema)


def pieces_report(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
