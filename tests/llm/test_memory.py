"""What a worker is given at once."""

import pyarrow as pa
import pytest

import corpus_pipeline

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def big_texts(spark, tmp_path):
    """Forty documents of 400 kB each in one partition, all labelled."""
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 400000 div 6) AS text").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.unset(KEY)
    yield spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    spark.conf.unset(KEY)


@pytest.mark.parametrize("stage", ["quality", "packing"])
def test_stages_exchange_small_batches_with_python(spark, big_texts, stage):
    docs, folder = big_texts
    dict(corpus_pipeline.STAGES)[stage](spark, docs, folder)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    found = docs.select("text").mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r.n for r in found) == 40 and max(r.size for r in found) < 6 << 20


def test_a_session_that_says_something_else_is_heard(spark, big_texts):
    docs, folder = big_texts
    spark.conf.set(KEY, "1m")
    corpus_pipeline.pack(spark, docs, folder)
    assert spark.conf.get(KEY) == "1m"
