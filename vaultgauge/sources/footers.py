"""Counts, smallest and largest values from the footers of Parquet files, without reading their data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vaultgauge.sources.sessions import session_with

# Types of load times whose smallest and largest value Spark takes from footers. Of timestamps it doesn't, as old files have them
# in no order; those without a zone don't keep their order when they are cast.
IN_FOOTERS = (T.DateType,)
PUSH_DOWN = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",  # all but Parquet
    "spark.sql.parquet.aggregatePushdown": "true",
}


def by_footers(df: DataFrame) -> DataFrame | None:
    """The same table, whose counts, minima and maxima alone are answered by footers; None if it is no plain scan of Parquet files.

    It belongs to a session of its own. Tables whose partitions a catalog knows are left out, as these may lie anywhere.
    """
    relation = file_relation(df)
    if relation is None or relation.fileFormat().toString() != "Parquet" or "InMemoryFileIndex" not in relation.location().getClass().getName():
        return None
    paths = relation.location().rootPaths()
    roots = [paths.apply(i).toString() for i in range(paths.size())]
    return session_with(df.sparkSession, PUSH_DOWN).read.schema(df.schema).parquet(*roots) if roots else None


def file_relation(df: DataFrame):
    """The files behind a DataFrame that is nothing but their rows; None for any other."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() == "SubqueryAlias":
        node = node.children().apply(0)
    if node.nodeName() != "LogicalRelation":
        return None
    relation = node.relation()
    return relation if "HadoopFsRelation" in relation.getClass().getName() else None


def is_plain_scan(df: DataFrame) -> bool:
    """Whether a DataFrame is nothing but the rows of files: those of a query may change while its files don't."""
    return file_relation(df) is not None and bool(df.inputFiles())
