"""Score, bands and texts of the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultgauge import rules


def status_count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def score(passed: Column, failed: Column) -> Column:
    """Share of passed among judged checks in whole percent, halves to the even number; 100 where none is judged."""
    judged = passed + failed
    return F.coalesce(F.bround(F.try_divide(passed * F.lit(100.0), judged)), F.lit(100.0)).cast("bigint")


def score_band(points: Column) -> Column:
    return reduce(
        lambda band, floor: F.when(points >= floor[0], F.lit(floor[1])).otherwise(band),
        reversed(rules.SCORE_BANDS),
        F.lit(rules.LOWEST_BAND),
    )


def grouped_number(value: Column) -> Column:
    return F.format_number(value.cast("bigint"), 0)


def status_label(status: Column, value: Column) -> Column:
    return (
        F.when(status == "FAIL", F.concat(F.lit("FAIL ("), grouped_number(value), F.lit(")")))
        .when(status == "INFO", grouped_number(value))
        .otherwise(status)
    )


def issue_text(status: Column, value: Column) -> Column:
    amount = F.when(status == "FAIL", grouped_number(value)).otherwise(F.lit("query"))
    return F.concat(amount, F.lit(" issue(s) found"))


def preview(text: Column) -> Column:
    n = rules.PREVIEW_CHARS
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…"))).otherwise(text)


def category_rank(category: Column) -> Column:
    """1, 2, … in report order; unknown categories last."""
    position = F.array_position(F.array(*map(F.lit, rules.CATEGORIES)), category)
    return F.when(position > 0, position).otherwise(F.lit(99)).cast("bigint")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), rules.NO_SLUG, "_")
