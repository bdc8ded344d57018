"""The stages of the pipeline against brute force, each on its own input."""

import re

import corpus_pipeline
from tests.llm.test_operators import brute_pairs
from vaultgauge.llm.quality import quality_scores
from vaultgauge.llm.toxicity import toxicity_scores

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    ids = lambda df: {r.doc_id for r in df.collect()}

    good = stages["quality"](spark, docs, SMALL)
    assert good.columns == columns and ids(good) == ids(quality_scores(docs, labels).where("score >= 0.3"))
    clean = stages["toxicity"](spark, good, SMALL)
    assert clean.columns == columns and ids(clean) == ids(toxicity_scores(good, labels).where("score < 0.5"))

    unique = stages["exact_dedup"](spark, docs, SMALL)
    want = {}
    for r in docs.collect():
        key = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        want[key] = max(want.get(key, -1), r.doc_id)
    assert unique.columns == columns and ids(unique) == set(want.values())

    single = stages["near_dedup"](spark, docs, SMALL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for doc in sorted(texts):
        first.setdefault(" ".join(texts[doc].lower().split()), doc)
    root = {d: first[" ".join(t.lower().split())] for d, t in texts.items()}
    pairs = brute_pairs(texts, 0.8)
    for _ in root:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        root = {d: root[root[d]] for d in root}
        if root == before:
            break
    assert single.columns == columns and ids(single) == set(root.values())


def test_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    pieces = corpus_pipeline.run(spark, SMALL)
    kept = pieces.select("doc_id").distinct().count()
    assert 0.4 * docs < kept < docs
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
