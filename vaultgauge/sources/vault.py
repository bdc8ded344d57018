"""Where the tables of a vault come from: a catalog database, Parquet folders or given DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vaultgauge.functions.sqltext import quoted
from vaultgauge.sources.sessions import session_with

# Seconds between attempts to list the columns of a table.
LISTING_PAUSES = (0.2, 1.0)
WITHOUT_BUCKETS = {"spark.sql.sources.bucketing.enabled": "false"}


class Vault:
    """Tables by name, in catalog order. A table is opened only when one of its checks is planned."""

    def __init__(
        self,
        spark: SparkSession,
        names: list[str],
        open_table: Callable[[str], DataFrame],
        column_names: Callable[[str], list[str]],
        qualifier: Sequence[str] = (),
        is_bucketed: Callable[[str], bool] = lambda name: False,
        unbucketed: Callable[[], Vault] | None = None,
    ):
        self.spark = spark
        self.names = names
        self.qualifier = list(qualifier)
        self._open = open_table
        self._opened: dict[str, DataFrame] = {}
        self._column_names = column_names
        self._bucketed: dict[str, bool] = {}
        self._is_bucketed = is_bucketed
        self._make_unbucketed = unbucketed

    @classmethod
    def from_database(cls, spark: SparkSession, database: str | Sequence[str]) -> Vault:
        """The tables of a database. A name with dots has parts, as catalog.database; a list gives the parts as they are."""
        parts = database.split(".") if isinstance(database, str) else list(database)
        full_database = ".".join(map(quoted, parts))
        names = [t.name for t in spark.catalog.listTables(full_database) if not t.isTemporary]

        def full_name(name):
            return f"{full_database}.{quoted(name)}"

        return cls(
            spark,
            names,
            lambda name: spark.table(full_name(name)),
            lambda name: [c.name for c in spark.catalog.listColumns(full_name(name))],
            qualifier=parts,
            is_bucketed=lambda name: any(c.isBucket for c in spark.catalog.listColumns(full_name(name))),
            unbucketed=lambda: cls.from_database(session_with(spark, WITHOUT_BUCKETS), parts),
        )

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Vault:
        frames = dict(frames)
        return cls(spark, list(frames), frames.__getitem__, lambda name: frames[name].columns)

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], file_format: str = "parquet") -> Vault:
        """Tables stored as files, one path per table; any format the session can read."""
        vault = cls(
            spark,
            list(paths),
            lambda name: spark.read.format(file_format).load(paths[name]),
            lambda name: vault.table(name).columns,
        )
        return vault

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def is_bucketed(self, name: str) -> bool:
        if name not in self._bucketed:
            self._bucketed[name] = self._is_bucketed(name)
        return self._bucketed[name]

    @cached_property
    def unbucketed(self) -> Vault:
        """The same tables, scanned by files instead of by buckets, so that a large bucket is read by many tasks."""
        return self._make_unbucketed() if self._make_unbucketed else self

    def _columns_or_error(self, name: str) -> tuple[list[str], str | None]:
        """The columns of a table, or why they could not be listed after some attempts; its row count check reports that."""
        for pause in (*LISTING_PAUSES, None):
            try:
                return self._column_names(name), None
            except Exception as e:
                if pause is None:
                    return [], f"COLUMNS_NOT_LISTED: {e}"
                time.sleep(pause)

    def listing(self) -> DataFrame:
        """position, source_name: every table of the database, in catalog order."""
        return self.spark.createDataFrame(
            pa.table(
                {
                    "position": pa.array(range(len(self.names)), pa.int64()),
                    "source_name": pa.array(self.names, pa.string()),
                }
            )
        )

    def columns_of(self, positions: list[int]) -> DataFrame:
        """position, source_name, column_names, columns_error: one row per given table."""
        names = [self.names[p] for p in positions]
        with ThreadPoolExecutor(8) as pool:  # one call to the catalog per table
            found = list(pool.map(self._columns_or_error, names))
        return self.spark.createDataFrame(
            pa.table(
                {
                    "position": pa.array(positions, pa.int64()),
                    "source_name": pa.array(names, pa.string()),
                    "column_names": pa.array([columns for columns, _ in found], pa.list_(pa.string())),
                    "columns_error": pa.array([error for _, error in found], pa.string()),
                }
            )
        )
