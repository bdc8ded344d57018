"""Intermediate results on shared storage, and what a folder holds."""

from __future__ import annotations

import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def can_store(spark: SparkSession) -> bool:
    """True where the session names a checkpoint folder; its driver and executors must share that."""
    return spark.sparkContext.getCheckpointDir() is not None


def stored(df: DataFrame) -> DataFrame:
    """The DataFrame written to the checkpoint folder, which outlives executors."""
    return df.checkpoint(eager=True)


def _located(spark: SparkSession, path: str):
    """A path and its file system, whatever store that is."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _located(spark, path)
    return files.exists(location)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, in order; none where there is no such path."""
    files, location = _located(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(location) if f.isDirectory()) if files.exists(location) else []


def remove(spark: SparkSession, path: str) -> None:
    files, location = _located(spark, path)
    files.delete(location, True)


def data_files(df: DataFrame) -> DataFrame:
    """file_path, file_bytes, modified of the files of a DataFrame, as its _metadata has them. Only their folders are listed."""
    spark = df.sparkSession
    names = [re.sub(r"^(\w+):///", r"\1:/", path) for path in df.inputFiles()]
    plain = [unquote(name) for name in names]
    given = spark.createDataFrame(pa.table({"file_path": pa.array(names, pa.string()), "path": pa.array(plain, pa.string())}))
    parents = sorted({path.rsplit("/", 1)[0] for path in plain})
    if not parents:
        return given.selectExpr("file_path", "0L AS file_bytes", "CAST(NULL AS TIMESTAMP) AS modified")
    listed = spark.read.format("binaryFile").load(parents).select(
        F.regexp_replace("path", r"^(\w+):///", "$1:/").alias("path"), F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified")
    )
    return given.join(listed, "path").select("file_path", "file_bytes", "modified")
