"""Partial results of a table's own checks, which can be kept and merged: one row per file, day of load and source.

They hold nothing that depends on the clock or on thresholds, so they answer the checks of any later run. What they cannot tell is how
many rows of the current day lie ahead of the clock, where some do: those files are read again for that.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultgauge.functions.clock import LoadTime, day, load_time
from vaultgauge.functions.sqltext import literal, quoted
from vaultgauge.operators.grain import can_hash_first
from vaultgauge.operators.profile import (
    KEY_BYTES, ROWS, SOURCE_SLOTS, bytes_of, measure_name, null_slots, slots_of_figures, slots_of_sources,
)
from vaultgauge.operators.target import Target
from vaultgauge.settings import Settings

FILE = ("file_path", "file_bytes", "modified")
FILE_OF_ROW = (
    "_metadata.file_path AS file_path", "_metadata.file_size AS file_bytes", "_metadata.file_modification_time AS modified",
)


def measures(df: DataFrame, target: Target) -> dict[str, str]:
    """What is kept: name -> aggregate over the rows of a group."""
    load = load_time(df, target.load_dts) if target.load_dts else None
    found = {ROWS: "count(*)"}
    for column in sorted(set(null_slots(target).values())):
        found[f"nulls {column}"] = f"count(CASE WHEN {quoted(column)} IS NULL THEN 1 END)"
    for column in sorted({*target.hk_columns, *([target.own_hk] if target.own_hk else [])}):
        found[f"bytes {column}"] = bytes_of(df, column)
    if load and load.is_usable:
        found |= {"earliest": f"min({load.value})", "latest": f"max({load.value})"}
        if load.is_text:
            found["malformed"] = f"count(CASE WHEN {load.raw} IS NOT NULL AND {load.value} IS NULL THEN 1 END)"
    return found


def can_keep(df: DataFrame, target: Target) -> bool:
    """Sources are kept as text, so equal ones must have equal texts."""
    return not target.record_source or can_hash_first(df, [target.record_source])


def partials(df: DataFrame, target: Target) -> DataFrame:
    """One row per file, day of load and source with the measures. A group is one row per task before the shuffle."""
    load = load_time(df, target.load_dts) if target.load_dts else None
    load_day = f"CAST({load.value} AS DATE)" if load and load.is_usable else "CAST(NULL AS DATE)"
    source = f"CAST({quoted(target.record_source)} AS STRING)" if target.record_source else "CAST(NULL AS STRING)"
    groups = [F.expr(e) for e in (*FILE_OF_ROW, f"{load_day} AS load_day", f"{source} AS source")]
    return df.groupBy(*groups).agg(*[F.expr(f"{over_rows} AS {quoted(name)}") for name, over_rows in measures(df, target).items()])


def profile_of_partials(df: DataFrame, groups: DataFrame, target: Target, wanted: Collection[str], settings: Settings) -> DataFrame:
    """The wanted slots of one table in long form, from its partial results; equal to those of `profile` over its rows."""
    wanted = set(wanted)
    sources = wanted & SOURCE_SLOTS
    if sources:
        per_source = groups.groupBy("source").agg(F.sum(ROWS).alias("source_rows"))
        found = slots_of_sources(per_source, target, sources, settings)
        rest = wanted - sources
        return found.unionByName(profile_of_partials(df, groups, target, rest, settings)) if rest else found
    load = load_time(df, target.load_dts) if target.load_dts else None
    merged = {ROWS: f"sum({ROWS})"}
    for slot, column in null_slots(target).items():
        merged[measure_name(slot)] = f"sum({quoted(f'nulls {column}')})"
    for slot in wanted:
        if slot.startswith(KEY_BYTES):
            column = slot.removeprefix(KEY_BYTES).removeprefix(":") or target.own_hk
            merged[measure_name(slot)] = f"sum({quoted(f'bytes {column}')})"
    counts_malformed = load is not None and load.is_text and not settings.lenient_timestamps
    if load and load.is_usable:
        merged |= {"latest": "max(latest)", "oldest": "min(earliest)"}
        for k in range(settings.spike_window_days + 1):
            merged[f"day_{k}"] = f"sum(CASE WHEN load_day = {day(settings, k)} THEN {ROWS} END)"
        if counts_malformed:
            merged["malformed"] = "sum(malformed)"
        if wanted & {"T2", "F2"}:
            merged["future"] = _future(df, groups, load, settings)
    figures = groups.agg(*[F.expr(f"coalesce({e}, 0) AS {n}" if n.startswith("day_") else f"{e} AS {n}") for n, e in merged.items()])
    return slots_of_figures(figures, target, wanted, load, counts_malformed, settings)


def _future(df: DataFrame, groups: DataFrame, load: LoadTime, settings: Settings) -> str:
    """Rows ahead of the clock as an aggregate over the groups."""
    whole = f"sum(CASE WHEN earliest > {settings.now} THEN {ROWS} END)"
    mixed = groups.where(f"earliest <= {settings.now} AND latest > {settings.now}")
    files = [r.file_path for r in mixed.select("file_path").distinct().collect()]  # of the current day only
    if not files:
        return f"coalesce({whole}, 0)"
    ahead = df.where(F.col("_metadata.file_path").isin(files)).where(f"{load.value} > {settings.now}").count()
    others = f"sum(CASE WHEN earliest > {settings.now} AND file_path NOT IN ({', '.join(map(literal, files))}) THEN {ROWS} END)"
    return f"{ahead}L + coalesce({others}, 0)"
