"""Helpers that several operators need: the shared folder, written tables, tokens of a text, sharding."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Where the session names none, a local session (tests) gets a temporary folder; a cluster gets an error, since a folder
    of one machine would lose data there. Folders are kept: results read from them lazily.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table: cuts the lineage, so that a lost executor costs a reread only."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True for the fifth of ids that no model may learn from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def hashed_share(column: str, share: float) -> Column:
    """True for about this share of the values, the same ones each time; for all of them from 1 on."""
    return F.pmod(F.xxhash64(column), F.lit(1_000_000)) < int(1_000_000 * min(1.0, share))


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on tasks exchange batches of about so many bytes with Python, where the session says nothing else (Spark: 64 MB).

    A batch is held by the JVM, beside its heap, and by the worker at once, for each task of an executor. Frames are planned when
    they are read, so the setting stays; it changes no result.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, size)


def give_back() -> None:
    """Returns to the system what a finished task has freed. Workers wait for further tasks, beside those of other stages and the
    JVM, and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def giving_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that gives memory back at its end."""

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run
