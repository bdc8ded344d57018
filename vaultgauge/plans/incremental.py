"""Partial results per file, kept between runs: only files that are new or have changed since are read."""

from __future__ import annotations

import hashlib
import json
import logging
import threading
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultgauge.functions.storage import data_files, exists, folders, remove
from vaultgauge.operators.partials import FILE, can_keep, measures, partials
from vaultgauge.operators.target import Target
from vaultgauge.settings import Settings
from vaultgauge.sources.footers import is_plain_scan
from vaultgauge.sources.vault import Vault

LOG = logging.getLogger(__name__)
# New files of one scan: their names are a condition of it.
FILES_PER_SCAN = 10_000
# Below a generation, when it is whole. Readers pass over such names.
WHOLE = "_whole"


class KeptPartials:
    """The partial results of a vault's tables below a folder.

    Per table and definition of what is kept there are generations: each is a whole table of partial results, written by one run. The
    last whole one counts; it and the one before it are kept, for runs that still read them.
    """

    def __init__(self, vault: Vault, settings: Settings):
        self.vault, self.settings = vault, settings
        self.folder = (settings.partials_folder or "").rstrip("/")
        self._found: dict[str, DataFrame | None] = {}
        self._lock = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}

    def of(self, target: Target) -> DataFrame | None:
        """The partial results of a table as it is now; None where there can be none. Asked again in a run: the same ones."""
        if not self.folder:
            return None
        with self._lock:
            lock = self._locks.setdefault(target.name, threading.Lock())
        with lock:
            if target.name not in self._found:
                try:
                    self._found[target.name] = self._up_to_date(target)
                except Exception as e:  # the rows themselves answer then, or say what is wrong
                    LOG.warning("no partial results of %s are kept: %s", target.name, e)
                    self._found[target.name] = None
            return self._found[target.name]

    def _up_to_date(self, target: Target) -> DataFrame | None:
        df, spark = self.vault.table(target.source_name), self.vault.spark
        if not (is_plain_scan(df) and can_keep(df, target)):
            return None
        database = ".".join(self.vault.qualifier) or self.settings.database
        folder = f"{self.folder}/{quote(database, '')}/{quote(target.name, '')}/{_definition(spark, df, target)}"
        now = data_files(df)
        last = _generations(spark, folder)[-1:]
        before = spark.read.parquet(f"{folder}/{last[0]}") if last else None
        new = kept = None
        if before is not None:
            # A file is known by name, size and time: one that was written anew is a new one.
            known = before.select(*FILE).distinct()
            new = [r.file_path for r in now.join(known, list(FILE), "left_anti").select("file_path").collect()]
            gone = known.join(now, list(FILE), "left_anti").limit(1).count()
            if not new and not gone:
                return before
            kept = before.join(now.select(*FILE), list(FILE), "left_semi")
        path = f"{folder}/generation-{int(last[0].rsplit('-', 1)[1]) + 1 if last else 0:09d}"
        _generation(df, target, kept, new).write.mode("overwrite").parquet(path)
        spark.range(1).write.mode("overwrite").parquet(f"{path}/{WHOLE}")  # only now, when all of it is there
        for old in _generations(spark, folder)[:-2]:
            remove(spark, f"{folder}/{old}")
        return spark.read.parquet(path)


def _generation(df: DataFrame, target: Target, kept: DataFrame | None, new: list[str] | None) -> DataFrame:
    """The kept partial results and those of the new files. new: None, all files."""
    if new is None:
        return partials(df, target)
    scans = [new[i : i + FILES_PER_SCAN] for i in range(0, len(new), FILES_PER_SCAN)]
    return reduce(DataFrame.unionByName, [partials(df.where(F.col("_metadata.file_path").isin(files)), target) for files in scans], kept)


def _generations(spark: SparkSession, folder: str) -> list[str]:
    """The whole ones, in order. What a lost writer has left counts for nothing and is overwritten by the next."""
    return [g for g in folders(spark, folder) if g.startswith("generation-") and exists(spark, f"{folder}/{g}/{WHOLE}")]


def _definition(spark: SparkSession, df: DataFrame, target: Target) -> str:
    """What is kept, as a digest: with other columns, types, rules or another time zone all files are read anew."""
    what = [measures(df, target), target.load_dts, target.record_source, df.schema.json(), spark.conf.get("spark.sql.session.timeZone")]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()[:16]
