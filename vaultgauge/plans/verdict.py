"""From a value to a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_of(kind: Column, value: Column, error: Column) -> Column:
    return (
        F.when(error.isNotNull(), F.lit("ERROR"))
        .when(kind == "info", F.lit("INFO"))
        .when(F.coalesce(value, F.lit(0)) != 0, F.lit("FAIL"))
        .otherwise(F.lit("PASS"))
    )


def with_status(results: DataFrame) -> DataFrame:
    """Adds the status; a missing value is 0, and an error has no value."""
    error = F.col("error")
    value = F.when(error.isNull(), F.coalesce("value", F.lit(0).cast("bigint")))
    return results.select(
        "seq", "category", "table_name", "table_type", "check_id", "check_name", "kind", "impact", "query_text",
        value.alias("value"),
        status_of(F.col("kind"), F.col("value"), error).alias("status"),
        "error",
    )
