"""The registered queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from vaultgauge.llm import (
    bpe, fingerprint, hard_negatives, jaccard_join, license_scan, line_dedup, packing, quality, resampling, toxicity, url_filter, wavelet,
)
from vaultgauge.llm import exact_dedup as exact
from vaultgauge.llm.shared import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, how many of them are later copies, and the digest of the text without these."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and decision of each document."""
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's licenses in the order of the text: lines, offsets, names, size reductions in percent, and words that differ."""
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    joined = lambda value: F.concat_ws(";", F.transform("findings", value))
    return found.select(
        "doc_id",
        F.size("findings").alias("n_findings"),
        joined(lambda f: f["line"].cast("string")).alias("lines"),
        joined(lambda f: f["offset"].cast("string")).alias("offsets"),
        joined(lambda f: f["license"]).alias("licenses"),
        joined(lambda f: F.floor(f["reduction"] * 100).cast("string")).alias("reductions"),
        joined(lambda f: F.concat_ws(" ", f["missing"])).alias("missing"),
        joined(lambda f: F.concat_ws(" ", f["added"])).alias("added"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the document that stays of its group of equal texts."""
    groups = exact.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP4_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces and where they lie."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pieces_report(packing.packed(table(spark, sf_dir, "documents"), path))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of the text decoded from them."""
    trip = bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return trip.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each page's URL."""
    return url_filter.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and decision of each document."""
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of equal shingles, the number of classes linked to it, and its group of near duplicates."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    found = fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place and checksum, read back from the files of wavelet matrices."""
    return wavelet.token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of each document in a draw towards the benchmark's words."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The reversed CRC-32 by bytes, over the distinct words only.
OP12_SQL = r"""
WITH crc AS (SELECT list(c ORDER BY n) AS t FROM (
  SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
  FROM range(256) AS r(n))),
texts AS (SELECT 'd' AS side, row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
words AS (SELECT side, row_no, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
codes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
buckets AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, crc.t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket FROM codes, crc),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain
  FROM counts),
docs AS (SELECT row_no, count(*) AS n, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight
  FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN docs USING (row_no) WHERE side = 'd'),
drawn AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
  10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank FROM drawn
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of each anchor and positive."""
    return hard_negatives.mined(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


OP13_SQL = """
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.row_no AS anchor_row, b.vec_id, b.row_no, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.row_no <> b.row_no WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_row, p.row_no ORDER BY n.score DESC, n.vec_id)::INT AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.anchor_row = n.anchor_row AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_line_dedup, op2_toxicity, op3_license_scan, op4_exact_dedup, op5_packing, op6_bpe, op7_url_filter, op8_quality,
        op9_jaccard_join, op10_fingerprint, op11_token_output, op12_resampling, op13_hard_negatives,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op12_resampling": OP12_SQL, "op13_hard_negatives": OP13_SQL}
