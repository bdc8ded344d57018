"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

A sequence of tokens is the BPE encoding of its bytes exactly if each two neighbours are: so every prefix of a piece has
one possible last token. For each prefix, the automaton gives the tokens that are suffixes of it; the one that is
compatible with the last token of what remains before it is stored, and following the stored tokens back from the end
gives the ids. No merge is ever replayed over the text.

Pieces repeat a lot, so each task keeps the ids of the pieces that it has met, up to a fixed number of them.
"""

from __future__ import annotations

import functools
import json
import math
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.shared import give_back, text_of

#: How byte-level vocabularies split a text.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that are one piece with the space before them: Latin letters, on which all versions of Unicode agree.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
#: White space on both sides of a space, or before one that ends the text: there a space need not begin a piece.
ODD_SPACES = r"\s (?:\s|\Z)"
#: Words whose ids a task keeps; beyond, the older half goes. Bounds memory only.
KEPT_WORDS = 300_000
#: Pairs of tokens whose compatibility it keeps.
KEPT_PAIRS = 400_000
#: States and bytes of which it keeps where the automaton goes on after a failure.
KEPT_STEPS = 100_000
#: Characters of texts whose new pieces are encoded together.
TOGETHER = 3 << 20


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable bytes for themselves, others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Kept(dict):
    """A bounded memo of two generations: when the younger one is full, the older one goes. What is asked for again stays."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, limit // 2, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self._age()
        self[key] = value
        return value

    def _age(self) -> None:
        self.older = dict(self)
        self.clear()

    def keep(self, more: dict) -> None:
        if len(self) + len(more) > self.limit:
            self._age()
        self.update(more)

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def lacking(self, keys: set) -> set:
        """Those of the keys that neither generation has."""
        return keys.difference(self, self.older)


def _shared_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differing.bit_length() + 7) // 8


class Vocabulary:
    """A byte-level BPE vocabulary file: tokens, merges by rank, special tokens."""

    def __init__(self, path: str, with_merges: bool = True):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        names, model = byte_names(), content["model"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ids = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self.tokens: dict[int, bytes] = {i: token for token, i in ids.items()} | {i: s.encode() for s, i in special.items()}
        self.ids, self.special = ids, special
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"] if with_merges else []):
            left, right = (bytes(names[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            if (made := ids.get(left + right)) is not None:
                self.rank[ids[left], ids[right]] = rank
                self.parts.setdefault(made, (ids[left], ids[right]))
                self.born.setdefault(made, rank)
        self.split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None


class Suffixes:
    """An automaton over some tokens: after each byte, the tokens that are suffixes of what has been read, the longest first.

    States are the prefixes of tokens. fail: the longest proper suffix that is a state; shorter: the longest one that is a token.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.step: dict[int, int] = {}  # by state and byte in one number
        self.token, self.depth = [-1], [0]
        for token, content in tokens.items():
            state = 0
            for byte in content:
                key = state << 8 | byte
                following = self.step.get(key)
                if following is None:
                    following = self.step[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[state] + 1)
                state = following
            self.token[state] = token
        self.fail, self.shorter = [0] * len(self.token), [0] * len(self.token)
        for key, state in sorted(self.step.items(), key=lambda item: self.depth[item[1]]):  # short ones first
            before, byte = key >> 8, key & 255
            fail = self.after(self.fail[before], byte) if before else 0
            self.fail[state] = fail
            self.shorter[state] = fail if self.token[fail] >= 0 else self.shorter[fail]

    def after(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        step = self.step
        while (following := step.get(state << 8 | byte)) is None:
            if not state:
                return 0
            state = self.fail[state]
        return following


class Encoder:
    """Encodes texts by a vocabulary. One per Python worker."""

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        self.pieces = regex.compile(PIECES)
        self.letters = re.compile(LETTERS).fullmatch
        self.odd_spaces = re.compile(ODD_SPACES)
        self.right_edges = Kept(lambda t: self._edges(t, 1), 1 << 20)
        self.left_edges = Kept(lambda t: self._edges(t, 0), 1 << 20)
        # By the two ids in one number.
        self.compatible = Kept(lambda pair: self._first_merge(pair >> 32, pair & 0xFFFFFFFF) == math.inf, KEPT_PAIRS)
        self.suffixes = Suffixes({i: token for token, i in v.ids.items() if self._is_own_encoding(i)})
        self.failing = Kept(lambda key: self.suffixes.after(key >> 8, key & 255), KEPT_STEPS)  # by state and byte in one number
        self.piece_ids = Kept(self._piece_ids, KEPT_WORDS)
        self.word_ids = Kept(lambda word: self._plain_ids(" " + word), KEPT_WORDS)

    def _edges(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token at its left (0) or right (1) edge, each with the rank of the merge that takes it up."""
        edges, until = [], math.inf
        while True:
            edges.append((token, until))
            if token not in self.vocabulary.parts:
                return edges
            until = self.vocabulary.born[token]
            token = self.vocabulary.parts[token][side]

    def _first_merge(self, left: int, right: int) -> float:
        """The lowest rank of a merge across the border of two tokens, which would come before both are whole.

        Of equal merges the leftmost goes first: so a part at the left is gone by then, one at the right isn't.
        """
        first, rank = math.inf, self.vocabulary.rank
        for x, x_until in self.right_edges[left]:
            for y, y_until in self.left_edges[right]:
                r = rank.get((x, y))
                if r is not None and r < x_until and r <= y_until and r < first:
                    first = r
        return first

    def _is_own_encoding(self, token: int) -> bool:
        parts = self.vocabulary.parts.get(token)
        return parts is None or self._first_merge(*parts) == self.vocabulary.born[token]

    def _piece_ids(self, piece: str) -> bytes:
        return next(self._ids_of([piece.encode()]))

    def _ids_of(self, pieces: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of pieces by last tokens of their prefixes. What the prefixes that a piece shares with the one before have got
        is taken over, so pieces in order cost little."""
        compatible, next_of, failing = self.compatible, self.suffixes.step.get, self.failing
        token_of, depth, shorter = self.suffixes.token, self.suffixes.depth, self.suffixes.shorter
        states, last, starts, before = [0], [-1], [0], b""  # by length of the prefix: the state; its last token, and where that begins
        for piece in pieces:
            end = _shared_prefix(before, piece)
            if len(piece) >= len(last):
                more = len(piece) + 1 - len(last)
                states += [0] * more
                last += [-1] * more
                starts += [0] * more
            state = states[end]
            for byte in piece[end:]:
                key = state << 8 | byte
                state = next_of(key)
                if state is None:
                    state = failing[key]
                end += 1
                token, start = token_of[state], end - depth[state]
                if token < 0 or (start and ((own := last[start]) < 0 or not compatible[own << 32 | token])):
                    fits, token = shorter[state], -1
                    while fits:  # shorter tokens than the longest, and none at all, are rare
                        start = end - depth[fits]
                        if not start or ((own := last[start]) >= 0 and compatible[own << 32 | token_of[fits]]):
                            token = token_of[fits]
                            break
                        fits = shorter[fits]
                states[end], last[end], starts[end] = state, token, start
            ids = []
            while end:
                ids.append(last[end])
                end = starts[end]
            ids.reverse()
            yield struct.pack(f"<{len(ids)}I", *ids)
            before = piece

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        return np.frombuffer(next(self._ids_of([piece])), "<u4").tolist()

    def learn(self, texts: list[str]) -> None:
        """Encodes the pieces of some texts that aren't known yet, in order."""
        words, pieces = set(), set()
        for text in texts:
            words.update(text.split(" "))
        plain, pieces_of = {}, {}
        for w in self.word_ids.lacking(words):
            if self.letters(w):
                plain[w] = " " + w
            else:
                pieces_of[w] = self.pieces.findall(" " + w)
        pieces.update(plain.values(), *pieces_of.values())
        in_order = sorted(self.piece_ids.lacking(pieces))  # by code points, which is the order of their bytes
        self.piece_ids.keep(dict(zip(in_order, self._ids_of(map(str.encode, in_order)), strict=True)))
        of = self.piece_ids.__getitem__
        found = {w: of(own) for w, own in plain.items()}
        found |= {w: of(own[0]) if len(own) == 1 else b"".join(map(of, own)) for w, own in pieces_of.items()}
        self.word_ids.keep(found)

    def forget(self) -> None:
        """Gives back what a task has learnt: workers live longer than that, and serve other operators as well."""
        for kept in (self.word_ids, self.piece_ids, self.compatible, self.failing):
            kept.forget()

    def _plain_ids(self, text: str) -> bytes:
        return b"".join(map(self.piece_ids.__getitem__, self.pieces.findall(text)))

    def _text_ids(self, text: str) -> bytes:
        """A space after anything but white space always begins a piece: there texts are cut, and what lies between is looked up whole."""
        if not text:
            return b""
        first, *words = text.split(" ")
        if self.odd_spaces.search(text):
            whole = [first]
            for w in words:
                if not whole[-1] or whole[-1][-1].isspace():
                    whole[-1] += " " + w
                else:
                    whole.append(w)
            first, *words = whole
        return self._plain_ids(first) + b"".join(map(self.word_ids.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        special = self.vocabulary.special
        if not any(s in text for s in special):
            return self._text_ids(text)
        parts = self.vocabulary.split_special.split(text)
        return b"".join(np.array([special[p]], "<u4").tobytes() if p in special else self._text_ids(p) for p in parts)

    def decode(self, ids: bytes) -> str:
        """The text of such ids; bytes that are no UTF-8 become U+FFFD, ids that the vocabulary lacks are left out."""
        of = np.frombuffer(ids, "<u4").tolist()
        try:
            content = b"".join(map(self.vocabulary.tokens.__getitem__, of))
        except KeyError:
            content = b"".join([self.vocabulary.tokens.get(i, b"") for i in of])
        return content.decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def together(texts: pa.Array, size: int) -> Iterator[list[str]]:
    """The texts in lists of about so many characters: all of a batch at once would be held twice."""
    some, held = [], 0
    for text in texts:
        some.append(text.as_py())
        held += len(some[-1])
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


def encoded(text: Column, path: str) -> Column:
    """The ids of a text as binary: little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = encoder(path)
        try:
            for texts in batches:
                ids = []
                for some in together(texts, TOGETHER):
                    known.learn(some)
                    ids += map(known.encode, some)
                yield pa.array(ids, pa.binary())
        finally:
            known.forget()
            give_back()

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of such ids."""

    @F.arrow_udf("string")
    def decode(values: pa.Array) -> pa.Array:
        of = encoder(path).decode
        return pa.array([of(v.as_py()) for v in values], pa.string())

    return decode(ids)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary) and decoded (the text of these ids) of each row; a null text is empty, and an empty text has no ids.

    Special tokens written out in a text get their own id, as the vocabulary's library does. Rows that repeat stay
    repeated; other columns are left out.
    """
    return docs.select("doc_id", encoded(text_of(), path).alias("ids")).withColumn("decoded", decoded(F.col("ids"), path))
