"""Tables bucketed by their keys: joins and groupings on them need no shuffle where the buckets match and none of them is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.functions.storage import data_files
from vaultgauge.settings import Settings

# How plans name the exchanges that move rows by key, and where the number of a bucket stands in a file's name.
KEY_EXCHANGES = ("Exchange hashpartitioning", "Exchange rangepartitioning")
BUCKET_OF_FILE = r"_(\d+)(?:\.[^/]*)?$"


def moves_rows(df: DataFrame) -> bool:
    """Whether the plan of a DataFrame sends rows to other tasks by a key. Nothing is run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(exchange in plan for exchange in KEY_EXCHANGES)


def has_hot_bucket(df: DataFrame, settings: Settings) -> bool:
    """Whether one bucket of a table is so much larger than the others that its task would hold up the pass.

    Sizes are those of the files, by the number in their names; their contents aren't read.
    """
    files = data_files(df).select(F.regexp_extract("file_path", BUCKET_OF_FILE, 1).alias("bucket"), "file_bytes")
    sizes = files.where("bucket <> ''").groupBy("bucket").agg(F.sum("file_bytes").alias("bytes"))
    r = sizes.agg(F.max("bytes").alias("largest"), F.avg("bytes").alias("usual")).first()
    return bool(r.largest) and r.largest > settings.hot_bucket_bytes and r.largest > settings.hot_bucket_factor * r.usual
