"""Sessions that differ from another one in a few settings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def session_with(spark: SparkSession, changes: Mapping[str, str]) -> SparkSession:
    """A session of the same application and with the same settings, but for some. Catalogs and files are shared, temporary views are not."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in changes.items():
        session.conf.set(name, value)
    return session
