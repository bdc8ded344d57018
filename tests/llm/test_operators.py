"""Each operator against a brute-force version, the library that it must equal, or held-out labels."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vaultgauge.llm import bpe, exact_dedup, fingerprint, jaccard_join, license_scan, line_dedup, packing, quality, queries, toxicity, url_filter
from vaultgauge.llm.components import components
from vaultgauge.llm.shared import shared_folder

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


# ---- 1 ----

def brute_line_dedup(docs, least):
    """Later copies of all runs of lines with enough words, by trying every run."""
    first, gone = {}, {}
    for doc, text in docs:
        lines = [s.strip() for s in text.split("\n") if s.strip()]
        gone[doc] = set()
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += len(lines[j].split())
                if words >= least:
                    where = first.setdefault(tuple(lines[i : j + 1]), (doc, i))
                    if where != (doc, i) and not (where[0] == doc and i < where[1] + j + 1 - i):
                        gone[doc].update(range(i, j + 1))
    return gone


def test_line_dedup(spark):
    r = random.Random(1)
    lines = [" ".join(r.choices("abc", k=r.randint(1, 4))) for _ in range(6)] + ["", "  "]
    docs = [(i, "\n".join(r.choices(lines, k=r.randint(0, 14)))) for i in range(60)]
    docs += [(100 + i, docs[5][1]) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    found = {}
    for x in line_dedup.later_copies(df, 5).collect():
        found.setdefault(x.doc_id, set()).add(x.idx)
    assert found == {k: v for k, v in brute_line_dedup(docs, 5).items() if v}
    out = {x.doc_id: x for x in line_dedup.line_dedup(df, 5).collect()}
    for doc, text in docs:
        places = [k for k, s in enumerate(text.split("\n")) if s.strip()]
        cut = {places[i] for i in found.get(doc, ())}
        assert out[doc].text == "\n".join(s for k, s in enumerate(text.split("\n")) if k not in cut)
        assert (out[doc].n_lines, out[doc].n_deleted) == (len(places), len(cut))


def test_line_dedup_of_many_lines(spark):
    """Linear in the lines of a document: two texts of 50,000 lines with words, and blank ones in between."""
    import time

    lines = [f"line {i % 40_000} of a long text" for i in range(50_000)]
    docs = spark.createDataFrame([(1, "\n \n".join(lines)), (2, "\n".join(lines)), (3, "\n".join(["the same line"] * 50_000))], "doc_id int, text string")
    began = time.monotonic()
    found = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert time.monotonic() - began < 120
    # The last ten thousand lines of the first text are its first ones again.
    assert (found[1].n_lines, found[1].n_deleted) == (50_000, 10_000) and found[1].text.split("\n")[::2][:40_000] == lines[:40_000]
    assert (found[2].n_lines, found[2].n_deleted, found[2].text) == (50_000, 50_000, "")
    # Runs of 17 equal lines have 51 words; those that overlap the first one stay.
    assert found[3].n_lines == 50_000 and found[3].n_deleted == 50_000 - 17


# ---- 2 and 8 ----

def held_out_scores(spark, name, label):
    scores = queries.queries()[name](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    return np.array([r.score for r in rows]), np.array([r.label for r in rows]), np.array([r.predicted for r in rows])


@pytest.mark.parametrize(("name", "label", "accuracy"), [("op2_toxicity", "toxic", 0.9), ("op8_quality", "quality", 0.95)])
def test_held_out(spark, name, label, accuracy):
    score, truth, predicted = held_out_scores(spark, name, label)
    assert (predicted == truth).mean() >= accuracy
    above = score[truth == 1][:, None] - score[truth == 0][None, :]
    assert ((above > 0) + 0.5 * (above == 0)).mean() >= 0.8



def test_toxicity_learns_phrases_of_ordinary_words(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(300)]
    phrase = vocabulary[:6]

    def text(toxic):
        w, parts = rng.choices(vocabulary, k=64), [phrase if toxic else rng.sample(phrase, 6) for _ in range(6)]
        return " ".join(w[:16] + sum(([*p, *rng.choices(vocabulary, k=2)] for p in parts), []) + w[16:])  # the words of the phrase are in both

    rows = [(i, text(i % 2), i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(df.drop("toxic"), df.drop("text")).where("held_out").collect()}
    above = np.subtract.outer([s for i, s in scores.items() if i % 2], [s for i, s in scores.items() if not i % 2])
    assert ((above > 0) + 0.5 * (above == 0)).mean() >= 0.9


def test_toxicity_finds_single_short_words_at_every_place(spark):
    rng = random.Random(6)
    parts = ["ta", "ren", "mo", "lis", "du", "ka", "vor", "pe", "sin", "go"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 3)))

    def text(i):
        w = [word() for _ in range(96)]
        if i % 8 == 0:
            place = i // 8 % 8  # within a window of eight words
            w[place], w[place + 48] = rng.sample(["skumb", "klod", "fuzzi", "jerkh"], 2)
        return " ".join(w)

    df = spark.createDataFrame([(i, text(i), int(i % 8 == 0)) for i in range(2400)], "doc_id bigint, text string, toxic int")
    scores = toxicity.toxicity_scores(df.drop("toxic"), df.drop("text")).where("held_out").collect()
    assert np.mean([r.score >= toxicity.THRESHOLD for r in scores if r.doc_id % 8 == 0]) >= 0.9
    assert np.mean([r.score < toxicity.THRESHOLD for r in scores if r.doc_id % 8]) >= 0.98


# ---- 3 ----

def test_license_scan(spark, texts):
    odd = {
        -1: "Intro words\nRELEASED under MIT license, as is\nend", -2: "this license was released", -3: "Licensed under the Apache License Version 2.0 "
        + "and more words " * 40 + "Licensed under CC BY-NC 4.0.",
    }
    df = spark.createDataFrame(list((texts | odd).items()), "doc_id bigint, text string")
    found = {r.doc_id: r.findings for r in license_scan.license_scan(df).collect()}
    assert [(f.license, f.line, f.missing, f.added) for f in found[-1]] == [("MIT", 1, ["the"], [])]
    assert found[-2] == [] and sorted(f.license for f in found[-3]) == ["Apache-2.0", "CC-BY-NC-4.0"]
    for doc, text in texts.items():
        want = Counter(n for n, w in license_scan.TEMPLATES.items() for line in text.split("\n") if w.lower() in line.lower())
        assert Counter(f.license for f in found[doc] if not f.missing and not f.added) == want


@pytest.mark.parametrize("letters", [5, 8, 10, 20])
def test_license_scan_finds_exact_notices_amid_long_words(letters):
    rng = random.Random(letters)
    around = lambda: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=letters)) for _ in range(30))
    scan = license_scan.Scanner(tuple(license_scan.TEMPLATES.items()), license_scan.REDUCTION, license_scan.DIFFERENT).scan
    for name, wording in license_scan.TEMPLATES.items():
        for _ in range(20):
            assert [(f["license"], f["missing"], f["added"]) for f in scan(f"{around()} {wording} {around()}")] == [(name, [], [])]


def test_license_scan_finds_wrapped_notices(spark):
    texts = {
        1: "# a file\n# Licensed under the Apache License,\n# Version 2.0.\nimport this", 2: "Released\nunder\nthe\nMIT\n\nLicense",
        3: "x\r\n * This work is licensed under the GNU\r\n * General Public License, version 3.\r\n * Licensed under CC\r\n * BY-NC 4.0.",
    }
    rows = license_scan.license_scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    found = {r.doc_id: [(f.license, f.line, f.missing, f.added) for f in r.findings] for r in rows}
    assert found == {1: [("Apache-2.0", 1, [], [])], 2: [("MIT", 0, [], [])], 3: [("GPL-3.0", 1, [], []), ("CC-BY-NC-4.0", 3, [], [])]}


def test_license_scan_returns_every_wording_of_a_line(spark):
    once, less = "Released under the MIT License.", "Released under MIT License."
    text = f"İ first {once} some words {less} {once} {once} more words Licensed under CC BY-NC 4.0. {once}"
    (row,) = license_scan.license_scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    want = [("MIT", m.start(), ["the"] if m.group() == less else []) for m in re.finditer(r"Released[^.]*\.", text)]
    want.insert(4, ("CC-BY-NC-4.0", text.index("Licensed"), []))
    assert [(f.license, f.offset, f.missing) for f in row.findings] == want and {f.line for f in row.findings} == {0}
    scan = license_scan.Scanner((("MIT", once),), license_scan.REDUCTION, license_scan.DIFFERENT).scan
    assert len(scan(" ".join([once] * 3000))) == 3000


def test_license_scan_knows_common_texts():
    scan = license_scan.Scanner(license_scan.WORDINGS, license_scan.REDUCTION, license_scan.DIFFERENT).scan
    for name, wording in license_scan.WORDINGS:
        text = "// " + "\n// ".join(wording.split(" "))
        assert [(f["license"], f["missing"], f["added"]) for f in scan(f"some code\n{text}\nmore code")] == [(name, [], [])], wording


def test_license_scan_savings_drop_no_wording_that_may_differ():
    rng = random.Random(3)
    for name, wording in license_scan.TEMPLATES.items():
        scan = license_scan.Scanner(((name, wording),), license_scan.REDUCTION, license_scan.DIFFERENT).scan
        words = license_scan.WORD.findall(wording)
        for _ in range(200):
            changed = list(words)
            for _ in range(int(license_scan.DIFFERENT * len(words))):
                k = rng.randrange(1, len(changed) - 1)
                changed[k : k + rng.choice([0, 1])] = rng.choice([[], ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30))]])
            if len(set(words) - set(changed)) + len([w for w in changed if w not in words]) <= int(license_scan.DIFFERENT * len(words)):
                assert [f["license"] for f in scan(" ".join(changed))] == [name], changed


def test_license_scan_size_reduction_decides_between_templates():
    """Both wordings differ from the text by one word; the one whose other words save more bytes counts."""
    long = "redistribution acknowledgements notwithstanding"
    templates = (("short", "by a of to in it notwithstanding acknowledgements xx"), ("long", f"by a of to in it {long}"))
    scan = license_scan.Scanner(templates, license_scan.REDUCTION, 0.5).scan
    for order in (templates, templates[::-1]):
        scan = license_scan.Scanner(order, license_scan.REDUCTION, 0.5).scan
        (found,) = scan(f"first by a of to in it {long} last")
        assert found["license"] == "long"
    same = (("plain", "the work of all is given as it stands here"), ("exact", "the work of all is given as it stands now"))
    for order in (same, same[::-1]):
        (found,) = license_scan.Scanner(order, license_scan.REDUCTION, license_scan.DIFFERENT).scan("the work of all is given as it stands now")
        assert (found["license"], found["missing"]) == ("exact", [])


def test_license_scan_needs_compression():
    """Templates that save nothing on a block are not confirmed there, however their words fit."""
    scanner = license_scan.Scanner(tuple(license_scan.TEMPLATES.items()), license_scan.REDUCTION, license_scan.DIFFERENT)
    text = "first words. " + " ".join(license_scan.TEMPLATES.values())
    assert len(scanner.scan(text)) == 4
    scanner.given = [t._replace(compressor=scanner.plain) for t in scanner.given]
    assert scanner.scan(text) == []


def test_license_scan_is_linear_in_the_notices_of_a_text():
    import time

    scan = license_scan.Scanner(license_scan.WORDINGS, license_scan.REDUCTION, license_scan.DIFFERENT).scan
    took = []
    for n in (2_000, 20_000):
        text = " ".join(f"{w} word{i}" for i in range(n // 4) for w in license_scan.TEMPLATES.values())
        began = time.process_time()
        assert len(scan(text)) == n
        took.append(time.process_time() - began)
    assert took[1] < 25 * took[0]
    # A notice at the end of a long stretch of license words.
    text = "license version public the under " * 30_000 + license_scan.TEMPLATES["MIT"]
    assert [f["license"] for f in scan(text) if not f["missing"] and not f["added"]][-1] == "MIT"


# ---- 4 ----

def test_exact_groups_with_collisions(spark):
    """A digest that collides (the length) gives the same groups, by comparing bytes."""
    r = random.Random(4)
    rows = [(i, "".join(r.choices("aAbÉé", k=r.randint(0, 3)))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    want = {}
    for i, t in rows:
        want.setdefault(lower(t), []).append(i)
    for digest in (exact_dedup.sha256, lambda body: F.length(body).cast("string")):
        found = {x.doc_id: x for x in exact_dedup.exact_groups(df, digest).collect()}
        for i, t in rows:
            group = want[lower(t)]
            assert (found[i].keep_id, found[i].group_size, found[i].kept) == (max(group), len(group), i == max(group))


def test_exact_groups_over_batches(spark, texts):
    """The state goes on from one micro-batch of the stream to the next."""
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    rows = lambda found: {tuple(r) for r in found.drop("content_file").collect()}
    assert rows(exact_dedup.exact_groups(df, bytes_per_batch=1)) == rows(exact_dedup.exact_groups(df))


# ---- 5 ----

def test_packing(spark, texts, tokenizer):
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    sequences = {}
    starts = {}
    for r in packing.packed(df, PATH).collect():
        sequences.setdefault(r.sequence_id, []).append(r)
        starts.setdefault(r.doc_id, []).append(r)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        pieces = sorted(starts[doc], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == ids
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]])) and pieces[0].doc_tokens == len(ids) // 4
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        size = sum(r.length for r in pieces)
        assert size <= 2048 and size & (size - 1) == 0  # no padding


def test_level_of_least_squares():
    r = random.Random(5)
    packer = packing.Packer(16, 10**6)
    for doc in range(400):
        length = r.randint(1, 15)
        counts = packer.counts.copy()
        cost = {}
        for level in [h for h in range(1, 17 - length) if counts[h]] + [0]:
            after = counts.copy()
            after[level] -= level > 0
            after[level + length] += level + length < 16
            cost[level] = int((after.astype(int) ** 2).sum())
        assert packer.level_for(length) == max(h for h in cost if cost[h] == min(cost.values()))
        list(packer.add(doc, b"\0\0\0\0" * length))


# ---- 6 ----

def test_bpe_equals_the_library(spark, texts, tokenizer):
    r = random.Random(6)
    parts = [*"ab c\n\té漢😀'.,!AZ019²½_-", "  ", " the", "ing", "'ll", "<|endoftext|>", "\u0301", "\u00a0", "\u0085", "aaaa"]
    odd = ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(800)]
    encoder = bpe.Encoder(PATH)
    for text in [*odd, *list(texts.values())[:40]]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)
    row = queries.op6_bpe(spark, SMALL).where("doc_id = 5").first()
    assert row.decoded_sha256 == hashlib.sha256(texts[5].encode()).hexdigest() and row.n_tokens == len(tokenizer.encode(texts[5], add_special_tokens=False).ids)


def test_bpe_cuts_plain_words_without_the_pattern(tokenizer):
    class Seen(list):
        def findall(self, text):
            self.append(text)
            return cut(text)

    r = random.Random(9)
    texts = [" ".join("".join(r.choices("aeiouThstrénßŁ.',1漢", k=r.randint(1, 12))) for _ in range(300)) for _ in range(5)]
    known = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    cut, known.pieces = known.pieces.findall, Seen()
    known.learn(texts)
    assert known.pieces and not any(t[1:].isalpha() and "漢" not in t for t in known.pieces)
    for text in texts:
        assert np.frombuffer(known.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# ---- 7 ----

def test_url_rules(spark):
    urls = [
        "http://Example.ORG/es/1?x", "https://a.example.org/en/12", "x://org/", "x://org", "http://a.com/fr/#t", "http://b.a.com/de/", "nothing", "", None,
        "http://a.net/fr/", "http://notorg/", "http://example.org/en/2", "://a.org/p?/://", "HTTP://COM/FR/", "http://a.com/fr/",
    ]
    found = {r.page_id: r for r in url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")).collect()}
    for k, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = host.lower()
        fits = [(len(h + p), h + p, allow) for h, p, allow in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (found[k].host, found[k].path) == (host, path)
        assert found[k].rule == (max(fits)[1] if fits else None)
        if fits:
            assert found[k].verdict == ("allow" if max(fits)[2] else "block")
    assert {found[k].verdict for k in found} <= {"allow", "block"}


# ---- 9 ----

def brute_pairs(texts, threshold):
    sets = {}
    for doc, text in sorted(texts.items()):
        w = text.lower().split()
        shingles = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
        sets.setdefault(shingles, doc)
    items = [(s, d) for s, d in sets.items() if s]
    return {
        (min(a, b), max(a, b)) for k, (x, a) in enumerate(items) for y, b in items[k + 1 :]
        if min(len(x), len(y)) >= threshold * max(len(x), len(y)) and len(x & y) >= threshold * len(x | y) - 1e-9
    }


def near_copies(n, words, changes, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, changes)):
            w[r.randrange(words)] = f"v{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("bucket", [400, 20])
def test_jaccard_join(spark, bucket):
    """Also with buckets far smaller than the groups of near copies, which are split and compared in blocks."""
    texts = dict(enumerate(near_copies(60, 120, 4, 1) + near_copies(50, 60, 3, 2) + ["", "", "one two", "One  two", "a b c d e f"]))
    join = jaccard_join.Join(spark.createDataFrame(list(texts.items()), "doc_id int, text string"), bucket=bucket, max_depth=4)
    want = brute_pairs(texts, 0.8)
    found = [tuple(r) for r in join.pairs().collect()]
    assert len(found) == len(set(found)) and set(found) <= want  # each pair once
    assert len(found) >= 0.99 * len(want)
    links = Counter(d for pair in found for d in pair)
    grouped = {r.class_id: r for r in join.grouped().collect()}
    assert all(r.n_links == links[c] for c, r in grouped.items())
    root = {c: c for c in grouped}

    def top(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in found:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    assert all(r.group_id == top(c) for c, r in grouped.items())
    assert grouped[110].class_size == 2 and grouped[112].class_size == 2  # two empty texts, two of the same words


def test_jaccard_join_of_documents(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {tuple(r) for r in jaccard_join.Join(docs).pairs().collect()} == brute_pairs(texts, 0.8)


def test_components(spark):
    r = random.Random(9)
    edges = [(f"{r.randrange(80):02}", f"{r.randrange(80):02}") for _ in range(70)] + [("x", f"y{i}") for i in range(30)]
    found = {x.node: x.root for x in components(spark.createDataFrame(edges, "a string, b string"), shared_folder(spark, "test")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: root[n] for n in linked}


# ---- 10 ----

def test_fingerprints(spark, texts):
    rows = {r.doc_id: r for r in fingerprint.edited_fingerprints(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    order, errors = sorted(texts, reverse=True), []
    for k, doc in enumerate(order):
        text, after, row = texts[doc], texts[order[(k + 1) % len(order)]], rows[doc]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert row.edited == edited and row.n_chars == len(text)
        a, b, c = (shingles(t.lower().split()) for t in (text, edited, after))
        errors += [row.near_edited - len(a & b) / len(a | b), row.near_next - len(a & c) / len(a | c)]
        if row.fingerprint == rows[order[(k + 1) % len(order)]].fingerprint:
            assert row.near_next == 1.0
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.01
    same = {}
    for doc, text in texts.items():
        assert same.setdefault(text, rows[doc].fingerprint) == rows[doc].fingerprint
