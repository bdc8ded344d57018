"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns the rows that it keeps, with all columns; the last one returns the
pieces of the sequences. Null texts count as empty, and an empty table goes through every stage. Stages that run Python exchange
small batches with it, so executors that go through all stages in a row have memory left for both sides.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vaultgauge.llm.exact_dedup import exact_dedup
from vaultgauge.llm.jaccard_join import one_of_each_group
from vaultgauge.llm.packing import packed, pieces_report
from vaultgauge.llm.quality import good_documents
from vaultgauge.llm.shared import shared_folder, small_batches, table, written
from vaultgauge.llm.toxicity import clean_documents


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    small_batches(spark)
    return good_documents(docs, table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    small_batches(spark)
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (lower-casing A-Z only) the document with the largest doc_id stays."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (Jaccard similarity of five-word shingles from 0.8 on, over any number of links) the smallest doc_id stays."""
    small_batches(spark)
    return one_of_each_group(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences: where each lies, and a checksum of its ids."""
    small_batches(spark)
    return pieces_report(packed(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Trained models, MinHash and online packing have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written to the shared folder and read again by the next."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
