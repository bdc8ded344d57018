"""Everything a table tells about itself: NULLs, load times and volumes in one aggregate over one scan, without a
shuffle of its rows; sources in a count per source, which reads that column only. Partial aggregation leaves one row per
source and task, so a source with most of the rows is no heavier than any other, and of many sources only names and
counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultgauge.functions.clock import LoadTime, column_type, day, load_time, on_day
from vaultgauge.functions.sqltext import literal, quoted
from vaultgauge.operators.target import Target
from vaultgauge.settings import Settings

SOURCE_SLOTS = {"R1", "R2"}
# Row counts, newest and oldest load time: what the footers of files may answer.
FOOTER_SLOTS = {"T4", "F1", "F3", "rows"}
CLOCK_SLOTS = {"T2", "F1", "F2", "F3", "V1", "V2", "V3"}
# Sizes that choose the plan of the key checks; they are no checks themselves.
ROWS = "rows"
KEY_BYTES = "key_bytes"
BYTES_OF_OTHER_KEYS = 16


def null_slots(target: Target) -> dict[str, str]:
    """Slot and column of the checks that count NULLs."""
    found = {}
    if target.own_hk:
        found[{"HUB": "H1", "LINK": "L1", "SAT": "S1"}[target.table_type]] = target.own_hk
        if target.table_type == "SAT" and target.hash_diff:
            found["S4"] = target.hash_diff
    if target.table_type == "LINK":
        found.update({f"L2:{key}": key for key in target.references})
    if target.load_dts:
        found["T1"] = target.load_dts
    if target.record_source:
        found["T3"] = target.record_source
    return found


def profile_slots(target: Target) -> set[str]:
    slots = {*null_slots(target), "T4"}
    if target.load_dts:
        slots |= CLOCK_SLOTS
    if target.record_source:
        slots |= SOURCE_SLOTS
    return slots


def rows_that_matter(slot: str, target: Target, load: LoadTime | None, settings: Settings) -> str | None:
    """Rows outside this condition cannot change the value of the slot. None: every row counts."""
    nulls = null_slots(target)
    if slot in nulls:
        return f"{quoted(nulls[slot])} IS NULL"
    if slot in ("T2", "F2"):
        return load.within(settings.today)
    if slot == "V1":
        return load.within(day(settings, 1), settings.today)
    if slot == "V2":
        return load.within(day(settings, settings.spike_window_days), settings.today)
    if slot == "V3":
        return load.within(settings.today, settings.today)
    return None


def profile(df: DataFrame, target: Target, wanted: Collection[str], settings: Settings) -> DataFrame:
    """The wanted slots of one table in long form. One scan, and one of the source column where sources are wanted; with
    only a few slots wanted, the scan reads their columns only and, where all of them concern few rows, skips the rest of the
    file by its statistics."""
    wanted = set(wanted)
    sources = wanted & SOURCE_SLOTS
    if sources:
        found = _sources(df, target, sources, settings)
        return found.unionByName(profile(df, target, wanted - sources, settings)) if wanted - sources else found
    load = load_time(df, target.load_dts) if target.load_dts else None
    conditions = [rows_that_matter(slot, target, load, settings) for slot in sorted(wanted)]
    if conditions and all(conditions):
        df = df.filter(" OR ".join(conditions))

    measures = _measures(df, target, load, wanted, settings)
    figures = df.agg(*[F.expr(f"{over_rows} AS {name}") for name, over_rows in measures.items()])

    return slots_of_figures(figures, target, wanted, load, "malformed" in measures, settings)


def slots_of_figures(
    figures: DataFrame, target: Target, wanted: Collection[str], load: LoadTime | None, counts_malformed: bool, settings: Settings
) -> DataFrame:
    """The wanted slots in long form from the figures of the table."""
    clock_error = _clock_error(target, load, counts_malformed)
    values = _values(target, settings)
    cells = []
    for slot in sorted(wanted):
        value = f"CAST(coalesce({values[slot]}, 0) AS BIGINT)"
        error = "CAST(NULL AS STRING)"
        if slot in CLOCK_SLOTS and clock_error:
            # An unusable load time has no figures at all.
            value = f"CASE WHEN {clock_error} IS NULL THEN {value} END" if load.is_usable else "CAST(NULL AS BIGINT)"
            error = clock_error
        cells.append(f"{literal(slot)}, {value}, {error}")
    return _long_form(figures, target, cells)


def _sources(df: DataFrame, target: Target, wanted: set[str], settings: Settings) -> DataFrame:
    per_source = df.groupBy(F.expr(f"{quoted(target.record_source)} AS source")).agg(F.expr("count(*) AS source_rows"))
    return slots_of_sources(per_source, target, wanted, settings)


def slots_of_sources(per_source: DataFrame, target: Target, wanted: set[str], settings: Settings) -> DataFrame:
    figures = per_source.selectExpr("sum(source_rows) AS rows", "max(source_rows) AS top_source_rows", "count(source) AS sources")
    values = _values(target, settings)
    return _long_form(
        figures, target, [f"{literal(s)}, CAST(coalesce({values[s]}, 0) AS BIGINT), CAST(NULL AS STRING)" for s in sorted(wanted)]
    )


def _long_form(figures: DataFrame, target: Target, cells: list[str]) -> DataFrame:
    return figures.selectExpr(
        f"{literal(target.name)} AS table_name",
        f"stack({len(cells)}, {', '.join(cells)}) AS (slot, value, error)",
    )


def _measures(
    df: DataFrame, target: Target, load: LoadTime | None, wanted: set[str], settings: Settings
) -> dict[str, str]:
    """Figures of the table: name -> aggregate over its rows."""
    measures = {ROWS: "count(*)"}
    for slot, column in null_slots(target).items():
        if slot in wanted:
            measures[measure_name(slot)] = _rows_where(f"{quoted(column)} IS NULL")
    if wanted & CLOCK_SLOTS and load.is_usable:
        if wanted & {"T2", "F2"}:
            measures["future"] = _rows_where(f"{load.value} > {settings.now}")
        if "F1" in wanted:
            measures["latest"] = load.extreme("max")
        if "F3" in wanted:
            measures["oldest"] = load.extreme("min")
        days = {0} if wanted & {"V1", "V2", "V3"} else set()
        if "V1" in wanted:
            days.add(1)
        if "V2" in wanted:
            days.update(range(1, settings.spike_window_days + 1))
        for k in sorted(days):
            measures[f"day_{k}"] = _rows_where(on_day(load.value, settings, k))
        if load.is_text and not settings.lenient_timestamps:
            measures["malformed"] = _rows_where(f"{load.raw} IS NOT NULL AND {load.value} IS NULL")
    for slot in wanted:
        if slot.startswith(KEY_BYTES):
            measures[measure_name(slot)] = bytes_of(df, slot.removeprefix(KEY_BYTES).removeprefix(":") or target.own_hk)
    return measures


def bytes_of(df: DataFrame, column: str) -> str:
    is_text = isinstance(column_type(df, column), (T.StringType, T.BinaryType))
    return f"sum(CAST({f'octet_length({quoted(column)})' if is_text else BYTES_OF_OTHER_KEYS} AS BIGINT))"


def _rows_where(condition: str) -> str:
    # Spark computes count_if arguments in a projection of their own; this form needs none.
    return f"count(CASE WHEN {condition} THEN 1 END)"


def measure_name(slot: str) -> str:
    return quoted("nulls_" + slot)


def _clock_error(target: Target, load: LoadTime | None, counts_malformed: bool) -> str | None:
    """Why the load times of the table cannot be read, as an expression over its figures."""
    if load is not None and not load.is_usable:
        kind = load.dtype.simpleString()
        return literal(f"DATATYPE_MISMATCH: column {target.load_dts} of type {kind} holds no load time")
    if counts_malformed:
        text = literal(f" value(s) of column {target.load_dts} cannot be read as a timestamp")
        return f"CASE WHEN malformed > 0 THEN concat('CAST_INVALID_INPUT: ', malformed, {text}) END"
    return None


def _values(target: Target, settings: Settings) -> dict[str, str]:
    """Value of each slot from the figures of the table."""
    prior = [f"day_{k}" for k in range(1, settings.spike_window_days + 1)]
    # Average over the days that have rows.
    usual = f"try_divide({' + '.join(prior)}, {' + '.join(f'int({p} > 0)' for p in prior)})"
    return {
        **{slot: measure_name(slot) for slot in null_slots(target)},
        "T4": ROWS,
        ROWS: ROWS,
        KEY_BYTES: measure_name(KEY_BYTES),
        **{f"{KEY_BYTES}:{key}": measure_name(f"{KEY_BYTES}:{key}") for key in target.references},
        "T2": "future",
        "F2": "future",
        "F1": f"int(latest < {settings.now} - make_dt_interval(0, {settings.stale_hours}))",
        "F3": f"datediff({settings.today}, oldest)",
        "V1": "int(day_0 = 0 AND day_1 > 0)",
        "V2": f"int(day_0 > {settings.spike_multiplier} * {usual})",
        "V3": "day_0",
        "R1": f"int(top_source_rows * 100 >= {settings.single_source_percent} * rows)",
        "R2": "sources",
    }
