"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for each operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vaultgauge.llm import bpe, exact_dedup, fingerprint, jaccard_join, license_scan, line_dedup, packing, quality, toxicity, url_filter

PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = (
    "doc_id bigint, text string, digest string, score double, label int, idx int, node bigint, text_hash bigint, url string, "
    "keep_id int, part int, toxic int, statistics string, words string"
)
LONG = " ".join(f"word{i % 977} and" for i in range(30_000)) + "\n" + "x" * 50_000
ROWS = [
    (None, "a text without an id"), (None, None), (1, None), (2, ""), (3, LONG), (4, "Same text here, now ok"), (4, "Same text here, now ok"),
    (5, "SAME text here, now ok"), (6, " \n\t "), (7, "Released under the MIT License."), (8, "one"), (8, "two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, *[None] * 12) for i, t in ROWS], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 1, 1), (5, 0, 0), (7, None, None), (None, 1, 1), (8, 5, 7)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def each(docs, labels):
    return {
        "line_dedup": line_dedup.line_dedup(docs),
        "toxicity": toxicity.toxicity_scores(docs, labels),
        "license": license_scan.license_scan(docs),
        "exact": exact_dedup.exact_groups(docs),
        "bpe": bpe.bpe_round_trip(docs, PATH),
        "quality": quality.quality_scores(docs, labels),
        "jaccard": jaccard_join.near_duplicates(docs),
        "fingerprint": fingerprint.with_fingerprint(docs, "text", "fp"),
        "edited": fingerprint.edited_fingerprints(docs),
        "url": url_filter.judged(docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), "score", "part")),
    }


def test_odd_rows(docs, labels):
    for name, df in each(docs, labels).items():
        assert df.count() == len(ROWS), name
    packed = packing.packed(docs, PATH)
    assert packed.agg(F.sum("length")).first()[0] == sum(r.n for r in docs.select(
        (F.octet_length(bpe.encoded(F.coalesce("text", F.lit("")), PATH)) / 4 + 1).cast("int").alias("n")).collect())


def test_filters_keep_columns(docs, labels):
    for df in (
        exact_dedup.exact_dedup(docs), jaccard_join.one_of_each_group(docs), quality.good_documents(docs, labels), toxicity.clean_documents(docs, labels),
    ):
        assert df.columns == docs.columns
        df.collect()
    kept = {(r.doc_id, r.text) for r in exact_dedup.exact_dedup(docs).collect()}
    assert (5, "SAME text here, now ok") in kept and (4, "Same text here, now ok") not in kept and (2, "") in kept and (1, None) not in kept
    assert {r.doc_id for r in jaccard_join.one_of_each_group(docs).collect()} >= {4, 3, 7, 8}


def test_empty_tables(docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    for name, df in each(none, no_labels).items():
        assert df.count() == 0, name
    assert packing.packed(none, PATH).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, no_labels).collect()} == {0.0}
    assert {r.score for r in quality.quality_scores(docs, no_labels).collect()} == {0.5}
