"""License scan by conditional compression.

Candidate blocks are the stretches of a whole text's words, over all line breaks, that hold enough of a license template's words, in any
order: a bound that no confirmed wording can miss. Each block is compressed alone and with every candidate template as a raw zstandard
dictionary, and the bytes saved, against those that a template saves on its own text, rank the templates. The winner of a block
and those that come near it are confirmed: their words are aligned with the block's, and a license counts as found if the
wordings differ by few words, which are reported. Of two wordings for the same words the one with the larger size reduction counts.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.llm.shared import text_of

#: Names of licenses and the wording of their notices, as parameters with these defaults.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published "
    "by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_SPDX = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only "
    "LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 Unlicense"
)
#: All wordings that are searched for by default: the notices above, texts and headers in their usual wordings, and SPDX lines.
WORDINGS = (
    *TEMPLATES.items(),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
     "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     "agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
     "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", _GNU.format("program", "", "2")), ("GPL-3.0", _GNU.format("program", "", "3")),
    ("LGPL-2.1", _GNU.format("library", "Lesser ", "2.1")), ("LGPL-3.0", _GNU.format("library", "Lesser ", "3")),
    ("AGPL-3.0", _GNU.format("program", "Affero ", "3")),
    ("GPL-2.0", "GNU General Public License v2"), ("GPL-2.0", "GNU General Public License version 2"), ("GPL-2.0", "Public License v2"),
    ("GPL-3.0", "GNU General Public License v3"), ("GPL-3.0", "Public License v3"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, f"SPDX-License-Identifier: {name}") for name in _SPDX.split()),
)
#: Bytes that a template saves on a wording, at least, as a share of those that it saves on its own text. Only the wording itself
#: is compressed, so its neighbours don't count; the words that may differ leave more than this.
REDUCTION = 0.25
#: Words of the template that may be missing or different, as a share.
DIFFERENT = 0.25
#: A template is confirmed in a block only if it saves this share of its own bytes there, and of the share that the winner saves. A
#: block may hold several notices, and words around a wording cost some of its savings.
BLOCK_REDUCTION, NEAR_WINNER = 0.1, 0.1
#: Words of a piece that is compressed.
PIECE_WORDS = 4000

WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


class Template(NamedTuple):
    name: str
    words: list[str]
    ids: np.ndarray
    allowed: int
    compressor: zstandard.ZstdCompressor
    saved: int


class Span(NamedTuple):
    """A wording of a license: words from start to end, the places of those that are the template's, and how they differ."""

    name: str
    start: int
    end: int
    same: frozenset[int]
    reduction: float
    missing: tuple[str, ...]
    added: tuple[str, ...]

    def rank(self) -> tuple:
        return -self.reduction, len(self.missing) + len(self.added)


def _further(row: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Least numbers of different words up to each word of a text, with one more word of the template than in row."""
    steps = np.arange(len(row), dtype=np.int32)
    new = row + 1
    new[1:] = np.where(same, np.minimum(new[1:], row[:-1]), new[1:])
    return np.minimum.accumulate(new - steps) + steps


def _blocks(regions: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """Regions (start, end, template) in order, those that overlap together."""
    block, end = [], 0
    for region in regions:
        if block and region[0] >= end:
            yield block
            block = []
        block.append(region)
        end = max(end, region[1]) if len(block) > 1 else region[1]
    if block:
        yield block


class Scanner:
    """Templates with their compressors. One per Python worker."""

    def __init__(self, templates: tuple[tuple[str, str], ...], reduction: float, different: float):
        self.reduction = reduction
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        wordings = [(name, WORD.findall(wording.lower())) for name, wording in templates]
        self.place = {w: i for i, w in enumerate(sorted({w for _, words in wordings for w in words}), 1)}
        self.holds = np.zeros((1 + len(self.place), len(wordings)), bool)  # row 0: all other words
        self.given = []
        for t, (name, words) in enumerate(wordings):
            content = " ".join(words).encode()
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, write_dict_id=False, dict_data=dictionary)
            ids = np.array([self.place[w] for w in words], np.int32)
            self.holds[ids, t] = True
            saved = len(self.plain.compress(content)) - len(compressor.compress(content))
            self.given.append(Template(name, words, ids, min(math.floor(different * len(words)), len(words) - 1), compressor, saved))
        self.least = np.array([len(t.words) - t.allowed for t in self.given])
        self.longest = max(len(t.words) + t.allowed for t in self.given)

    def spans(self, words: list[str]) -> list[Span]:
        """The wordings of all licenses in their order, without those all of whose words belong to another one."""
        ids = np.fromiter((self.place.get(w, 0) for w in words), np.int32, len(words))
        hits = self.holds[ids]
        regions = [
            (low, high, t) for t in np.flatnonzero(hits.sum(0) >= self.least).tolist() for low, high in self._regions(hits[:, t], self.given[t])
        ]
        found = []
        for block in _blocks(sorted(regions)):
            for low, high, t in self._ranked(words, block):
                found += self._wordings(words, ids, low, high, self.given[t])
        found.sort(key=lambda f: (f.start, -f.end))
        kept: list[Span] = []
        near: list[Span] = []  # of those kept, the ones that reach beyond the start of the next
        for i, f in enumerate(found):
            near = [g for g in near if g.end > f.start]
            after = []
            for g in islice(found, i + 1, None):
                if g.start >= f.end:
                    break
                after.append(g)
            if not any(f.same < g.same or f.same == g.same and g.rank() <= f.rank() for g in near) and not any(
                f.same < g.same or f.same == g.same and g.rank() < f.rank() for g in after
            ):
                kept.append(f)
                near.append(f)
        return kept

    def _ranked(self, words: list[str], block: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The regions of a block's templates by the bytes that these save on the block, without those far behind the winner."""
        low, high = min(r[0] for r in block), max(r[1] for r in block)
        savings = dict.fromkeys((r[2] for r in block), 0.0)
        # Long blocks in overlapping pieces, as a dictionary is forgotten after a while.
        for start in range(low, high, PIECE_WORDS):
            content = " ".join(words[start : min(high, start + PIECE_WORDS + self.longest)]).encode()
            alone = len(self.plain.compress(content))
            for t in savings:
                template = self.given[t]  # one that is too short to save any on its own text: the words decide
                saved = (alone - len(template.compressor.compress(content))) / template.saved if template.saved > 0 else 1.0
                savings[t] = max(savings[t], saved)
        bar = max(BLOCK_REDUCTION, NEAR_WINNER * max(savings.values()))
        return sorted((r for r in block if savings[r[2]] >= bar), key=lambda r: (-savings[r[2]], r))

    def _regions(self, hits: np.ndarray, template: Template) -> Iterator[tuple[int, int]]:
        """Ranges of words outside of which no wording can lie: too few of the template's words in each range of its length."""
        length = len(template.words) + template.allowed
        total = np.concatenate([[0], np.cumsum(hits)])
        ends = np.minimum(np.arange(len(hits)) + length, len(hits))
        starts = np.flatnonzero(total[ends] - total[:-1] >= len(template.words) - template.allowed)
        if len(starts):
            cuts = np.flatnonzero(np.diff(starts) >= length)
            yield from zip(starts[[0, *cuts + 1]].tolist(), ends[starts[[*cuts, -1]]].tolist(), strict=True)

    def _wordings(self, words: list[str], ids: np.ndarray, low: int, high: int, template: Template) -> Iterator[Span]:
        """Wordings of a template that don't overlap, those that differ least first."""
        row = np.zeros(high - low + 1, np.int32)
        for w in template.ids:
            row = _further(row, ids[low:high] == w)
        ends = 1 + np.flatnonzero((row[1:] <= template.allowed) & (row[1:] <= row[:-1]))
        used = np.zeros(high - low, bool)
        for end in ends[np.argsort(row[ends], kind="stable")].tolist():
            first = max(0, end - len(template.words) - template.allowed)
            taken = np.flatnonzero(used[first:end])
            if len(taken):
                first += int(taken[-1]) + 1
            same = self._aligned(ids[low + first : low + end], template)
            if not same:
                continue
            places = frozenset(low + first + j for _, j in same)
            start, stop = min(places), max(places) + 1
            known = {i for i, _ in same}
            missing = tuple(w for i, w in enumerate(template.words) if i not in known)
            added = tuple(words[j] for j in range(start, stop) if j not in places)
            if len(missing) + len(added) > template.allowed:
                continue
            content = " ".join(words[start:stop]).encode()
            saved = len(self.plain.compress(content)) - len(template.compressor.compress(content))
            reduction = saved / template.saved if template.saved > 0 else 1.0  # too short to save any: the words decide
            if reduction >= self.reduction:
                used[start - low : stop - low] = True
                yield Span(template.name, start, stop, places, reduction, missing, added)

    def _aligned(self, part: np.ndarray, template: Template) -> list[tuple[int, int]]:
        """Places in the template and in a part that are matched, for a wording that ends with the part."""
        rows = [np.zeros(len(part) + 1, np.int32)]
        for w in template.ids:
            rows.append(_further(rows[-1], part == w))
        same, i, j = [], len(template.ids), len(part)
        while i and j:
            if part[j - 1] == template.ids[i - 1] and rows[i][j] == rows[i - 1][j - 1]:
                i, j = i - 1, j - 1
                same.append((i, j))
            elif rows[i][j] == rows[i - 1][j] + 1:
                i -= 1
            else:
                j -= 1
        return same

    def scan(self, text: str) -> list[dict]:
        """The findings of a whole text, in its order; a wording belongs to the line in which it starts."""
        words = [w.lower() for w in WORD.findall(text)]
        spans = self.spans(words)
        if not spans:
            return []
        places = [m.span() for m in WORD.finditer(text)]
        found, line, before = [], 0, 0
        for f in spans:
            start = places[f.start][0]
            line, before = line + text.count("\n", before, start), start
            found.append(
                {"license": f.name, "line": line, "offset": start, "reduction": f.reduction, "missing": list(f.missing),
                 "added": list(f.added), "wording": " ".join(words[f.start : f.end])}
            )
        return found


@functools.lru_cache(maxsize=4)
def scanner(templates: tuple[tuple[str, str], ...], reduction: float, different: float) -> Scanner:
    return Scanner(templates, reduction, different)


FINDING = "struct<license: string, line: bigint, offset: bigint, reduction: double, missing: array<string>, added: array<string>, wording: string>"


def license_scan(
    docs: DataFrame, templates: dict[str, str] | None = None, reduction: float = REDUCTION, different: float = DIFFERENT
) -> DataFrame:
    """One row per row of docs: doc_id, findings (license, line, offset, reduction, missing, added, wording), in the order of the text.

    Whole texts are scanned, also over line breaks. Each wording is a finding, with the line and the character at which it starts;
    those of one license don't overlap. Null text is empty and has no finding; rows that repeat stay repeated; an empty table
    gives none; other columns are left out.
    """
    given = WORDINGS if templates is None else tuple(templates.items())

    @F.arrow_udf(f"array<{FINDING}>")
    def scan(texts: pa.Array) -> pa.Array:
        kind = pa.list_(
            pa.struct(
                [("license", pa.string()), ("line", pa.int64()), ("offset", pa.int64()), ("reduction", pa.float64()), ("missing", pa.list_(pa.string())),
                 ("added", pa.list_(pa.string())), ("wording", pa.string())]
            )
        )
        of = scanner(given, reduction, different).scan
        return pa.array([of(t) for t in texts.to_pylist()], kind)

    return docs.select("doc_id", scan(text_of()).alias("findings"))
