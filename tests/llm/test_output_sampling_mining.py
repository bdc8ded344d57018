"""Wavelet files, importance resampling and hard negatives against brute force, the library or SQL."""

import glob
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vaultgauge.llm import hard_negatives, queries, resampling, wavelet
from vaultgauge.llm.shared import shared_folder, written

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id bigint, text string, score bigint, rank int, stretch int, start bigint, `key` string, place int, label int"
ODD = [
    (None, "a text without an id, whose words are still quite many: " + "so " * 30), (None, None), (1, None), (2, ""),
    (3, " ".join(f"word{i % 977}  and" for i in range(30_000)) + "\n" + "x" * 50_000), (4, "Same text here, now ok " * 8),
    (4, "Same text here, now ok " * 8), (4, "Same text here, now ok " * 8), (6, " \n\t \xa0 "), (8, "two<|endoftext|>  parts \x1c here "),
    (8, "ÄÖÜ straße 中文字 " * 20), (9, "it's  we'll\t\tgo \n\n  "), (-5, "below zero # \"quoted\" #"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, *[None] * 7) for i, t in ODD], COLUMNS)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def same_as_sql(spark, name, folder=SMALL):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    relation = duck.sql(queries.oracle_sql()[name])
    expected = sorted(map(repr, relation.fetchall()))
    found = queries.queries()[name](spark, folder)
    assert sorted(found.columns) == sorted(relation.columns)
    assert sorted(repr(tuple(r)) for r in found.select(*relation.columns).collect()) == expected


# ---- 11 ----

@pytest.mark.parametrize("n, most", [(0, 1), (1, 0), (7, 1), (40_000, 50_256), (100_000, 3), (65_536, 2**32 - 1)])
def test_file_answers_as_the_ids_do(n, most):
    r = np.random.default_rng(n)
    ids = np.minimum(r.zipf(1.3, n) - 1, most).astype(np.uint32)
    if n > 3:
        ids[3] = most
    shard = wavelet.Shard(wavelet.built(ids, np.array([n]) if n else np.array([], int)))
    assert shard.ids().tolist() == ids.tolist()
    for place in r.integers(0, n, 40) if n else []:
        assert shard.access(place) == ids[place]
    for token in {0, 1, 5, most, *map(int, ids[:5])}:
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        a, b = sorted(r.integers(0, n + 1, 2).tolist())
        assert shard.count(token, a, b) == int(((places >= a) & (places < b)).sum())
        for k in {0, 1, len(places) // 2, len(places) - 1}:
            assert shard.select(token, k) == (places[k] if 0 <= k < len(places) else None)


def test_file_is_compressed_and_read_in_part():
    ids = np.repeat(np.arange(500, dtype=np.uint32), 4000)
    data = wavelet.built(ids, np.array([len(ids)]))
    assert len(data) < len(ids) // 4
    shard = wavelet.Shard(data)
    assert shard.access(1_000_003) == 250 and shard.count(7, 20_000, 30_000) == 2000 and shard.select(499, 3999) == len(ids) - 1
    assert shard.block.cache_info().currsize < 10 * shard.planes < shard.sizes.size


def expected_report(rows, library):
    start, found = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        found.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_token_report(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [tuple(r) for r in queries.op11_token_output(spark, SMALL).orderBy("start").collect()]
    assert found == expected_report([(r.doc_id, r.text) for r in docs.collect()], library)


def test_shards_of_odd_rows(spark, odd, library):
    folder = shared_folder(spark, "odd")
    shards = wavelet.write_shards(odd, PATH, folder, shard_ids=100)
    files = glob.glob(f"{folder.removeprefix('file:')}/*.parquet")
    assert shards.count() > 3 and len([f for f in files if spark.read.parquet(f).count() == 1]) == shards.count()
    found = wavelet.document_ids(shards).collect()
    # Rows of one id may come in any order.
    texts = {i: sorted(zlib.crc32(np.array([*library.encode(t or "").ids, 2], "<u4").tobytes()) for j, t in ODD if i == j) for i, _ in ODD}
    assert {i: sorted(zlib.crc32(r.ids) for r in found if r.doc_id == i) for i in texts} == texts
    in_order = sorted(found, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order][:-1]]).tolist()
    assert [r.doc_id for r in in_order] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in in_order])
    counts = {r.token: r.n for r in wavelet.token_counts(shards, [2, 50256, 220, 99999]).collect()}
    assert counts == {t: int((every == t).sum()) for t in (2, 50256, 220, 99999)}
    assert sorted(r.place for r in wavelet.token_occurrences(shards, 2).collect()) == np.flatnonzero(every == 2).tolist()
    assert wavelet.token_report(odd.limit(0), PATH).count() == 0


def test_ids_are_those_of_the_library(spark, library):
    r = random.Random(3)
    signs = [" ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "'s", "'", "a", "Word", "12", "é", "中", "<|endoftext|>", "!", ".\n", "\u2003", "\ufeff"]
    rows = [(i, "".join(r.choices(signs, k=r.randint(0, 30)))) for i in range(2000)]
    found = wavelet.token_report(spark.createDataFrame(rows, "doc_id int, text string"), PATH)
    assert [tuple(x) for x in found.orderBy("start").collect()] == expected_report(rows, library)


def test_an_id_with_many_rows_spans_stretches(spark):
    docs = spark.range(900).selectExpr("IF(id < 300, 7, IF(id < 500, NULL, id)) AS doc_id", "string(id) AS text")
    found = wavelet.stretches(docs, 16).groupBy("stretch", "doc_id").count().collect()
    for of in (7, None):
        own = [r for r in found if r.doc_id == of]
        assert len(own) >= 3 and max(r["count"] for r in own) < 120
    by_stretch = {}
    for r in found:
        by_stretch.setdefault(r.stretch, []).append(-1 if r.doc_id is None else r.doc_id)
    in_order = sorted(by_stretch)
    assert all(max(by_stretch[a]) <= min(by_stretch[b]) for a, b in zip(in_order, in_order[1:], strict=False))


# ---- 12 ----

def test_resampling_sql(spark):
    same_as_sql(spark, "op12_resampling")


def brute_resampling(docs, target, percent, least_words, longest, buckets=10_000):
    def features(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    own, wanted = [0] * buckets, [0] * buckets
    for texts, counts in ((docs, own), ([(0, t) for t in target], wanted)):
        for _, text in texts:
            for b in features(text)[1]:
                counts[b] += 1
    s, t = sum(own) + buckets, sum(wanted) + buckets
    gains = [math.floor(1000 * math.log((wanted[b] + 1) * s / ((own[b] + 1) * t))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        words, found = features(text)
        weight = sum(gains[b] for b in found) // len(found) if found else 0
        score = None
        if doc is not None:
            h = int(__import__("hashlib").sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, len(words) >= least_words and doc is not None))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0]))
    k = percent * len(able) // 100
    ranks = [(*r[:4], i) for i, r in enumerate(able[:k], start=1)]
    return sorted(map(repr, ranks + [(*r[:4], None) for r in able[k:] + [r for r in rows if not r[4]]]))


@pytest.mark.parametrize("percent, longest", [(0, 1), (50, 1), (50, 3), (100, 2)])
def test_resampling_of_odd_rows(spark, odd, percent, longest):
    target = spark.createDataFrame([(None, 1), ("the same words, now", 2), ("", 3)], "text string, doc_id int")
    found = resampling.resampled(odd, target, percent, least_words=3, longest=longest)
    expected = brute_resampling(ODD, ["the same words, now"], percent, 3, longest)
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected
    assert resampling.resampled(odd.limit(0), target).count() == 0
    assert resampling.resampled(odd, target.limit(0), 100, 0).where("rank IS NOT NULL").count() == sum(i is not None for i, _ in ODD)


def test_kth_key_and_ranks_among_ties(spark):
    # A third of the rows share score and id.
    rows = [(5, 1, i) for i in range(200)] + [(random.Random(i).randint(0, 3), i % 7, 1000 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "score bigint, doc_id bigint, row_no bigint")
    folder = shared_folder(spark, "keys")
    keys = written(df.withColumn("key", resampling.composite_key()), f"{folder}/keys")
    in_order = sorted((-s, d, r) for s, d, r in rows)
    for k in (1, 2, 137, 200, 201, 599, 600):
        assert resampling.kth_key(keys, k, f"{folder}/{k}", pivots=4) == in_order[k - 1]
    assert resampling.kth_key(keys, 601, f"{folder}/x") is resampling.kth_key(keys, 0, f"{folder}/y") is None
    found = sorted((r["rank"], tuple(r.key)) for r in resampling.ranked(keys, folder).collect())
    assert found == list(enumerate(in_order, start=1))


# ---- 13 ----

def test_hard_negatives_sql(spark):
    same_as_sql(spark, "op13_hard_negatives")


def brute_negatives(rows, every, positives=5, negatives=10):
    kept = []
    for n, (vec_id, vector, label) in enumerate(rows):
        if vec_id is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((n, vec_id, label, [math.floor(256 * x) for x in vector]))
    found = []
    for n, anchor, label, q in kept:
        if anchor % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), i, m, same == label) for m, i, same, v in kept if m != n]
        for p, positive, _, _ in sorted(s for s in scores if s[3])[:positives]:
            fits = sorted((s, i) for s, i, _, same in scores if not same and 30 * -p <= 100 * -s <= 90 * -p)[:negatives]
            found += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fits, start=1)]
    return sorted(found)


@pytest.mark.parametrize("scale", [1.0, 4000.0, 2e6])
def test_hard_negatives_of_odd_rows(spark, scale):
    r = random.Random(int(scale))
    rows = [(r.randint(0, 40), [scale * r.choice((r.uniform(-1, 1), 0.5)) for _ in range(9)], r.randint(0, 2)) for _ in range(150)]
    rows += [(i, [scale * 0.5] * 9, i % 2) for i in range(60)]  # a vector that a third of the rows share
    rows += [
        (None, [1.0] * 9, 1), (10, None, 1), (10, [1.0, None], 1), (20, [float("nan")] * 9, 1), (30, [float("inf")] * 9, 1), (20, [1.0] * 9, None),
        (10, [], 1), (30, [0.25], 1), (40, [0.5] * 12, 2),
    ]
    df = spark.createDataFrame([(i, v, k, "x", 1) for i, v, k in rows], "vec_id bigint, embedding array<double>, label int, list string, score int")
    for round_anchors in (1000, 7):
        found = hard_negatives.mined(df, every=10, round_anchors=round_anchors)
        assert sorted(tuple(x) for x in found.collect()) == brute_negatives(rows, 10)


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(i, [3e9, 1.0], i % 2) for i in range(20)], "vec_id int, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mined(df, every=10)


def test_hard_negatives_without_anchors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert hard_negatives.mined(df.limit(0)).count() == 0
    assert hard_negatives.mined(df.where("vec_id % 100 > 0")).count() == 0
    alone = df.withColumn("label", F.lit(1))
    assert hard_negatives.mined(alone).count() == 0


def test_bounds_leave_few_candidates(spark, monkeypatch):
    """The last dimensions are read for a small part of the rows only."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    stored = hard_negatives.blocks(hard_negatives.usable(df).coalesce(1)).collect()
    read = []
    in_play = hard_negatives.Block._in_play

    def counted(sums, *rest):
        stays = in_play(sums, *rest)
        read.append((len(stays), int(stays.sum())))
        return stays

    monkeypatch.setattr(hard_negatives.Block, "_in_play", staticmethod(counted))
    block = hard_negatives.Block(stored[0].asDict())
    best = hard_negatives.Best(None, None, 5)
    block.search(block.columns[:, 0].astype(np.int64), block.labels == block.labels[0], [best])
    assert read[-1][1] < read[0][0] / 4
    scores = block.columns.astype(np.int64).T @ block.columns[:, 0].astype(np.int64)
    assert best.rows[:, 0].tolist() == sorted(scores[block.labels == block.labels[0]].tolist(), reverse=True)[:5]
