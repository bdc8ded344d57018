"""From checks to DataFrames: which operator answers which slot of which table, always in the same long form
(table_name, slot, value, error)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from vaultgauge.functions.clock import column_type
from vaultgauge.functions.storage import can_store
from vaultgauge.operators.grain import can_hash_first, duplicate_groups, duplicate_groups_hash_first, duplicate_groups_of
from vaultgauge.operators.orphans import Child, orphan_rows, shared_key_figures
from vaultgauge.operators.profile import CLOCK_SLOTS, FOOTER_SLOTS, profile, profile_slots
from vaultgauge.operators.target import Target
from vaultgauge.plans import catalog as catalog_plan
from vaultgauge.plans.specs import check_specs
from vaultgauge.rules import CHECKS
from vaultgauge.settings import Settings
from vaultgauge.sources.footers import IN_FOOTERS, by_footers
from vaultgauge.sources.vault import Vault


class Plan(NamedTuple):
    """The catalog and the checks of a vault, on the driver: some twenty short rows per table."""

    targets: dict[str, Target]
    specs: list[Row]
    by_table: dict[str, list[Row]]
    catalog: DataFrame
    numbers: dict[tuple[str, str], int]  # of the checks by table and slot, in the order of the whole plan

    def only(self, checks: Collection[str] | None, tables: Collection[str] | None) -> Plan:
        """The plan with the given checks and tables; unknown ones are an error, not an empty report."""
        names = None if tables is None else {t.upper() for t in tables}
        for given, known in ((checks, {c.check_id for c in CHECKS}), (names, set(self.targets))):
            if given is not None and (unknown := set(given) - known):
                raise ValueError(f"Unknown: {sorted(unknown)}. Known: {sorted(known)}")
        specs = [s for s in self.specs if (checks is None or s.check_id in checks) and (names is None or s.table_name in names)]
        by_table = {t: [s for s in specs if s.table_name == t] for t in self.targets}
        kept = {t for t, own in by_table.items() if own}
        wanted = {(s.table_name, s.key_column) for s in specs}
        targets = {n: t._replace(references={k: p for k, p in t.references.items() if (n, k) in wanted}) for n, t in self.targets.items()}
        kept |= {p for n in kept for p in targets[n].references.values() if p}  # parents are measured
        return self._replace(targets={n: t for n, t in targets.items() if n in kept}, specs=specs, by_table=by_table)

    def slots(self, target: Target) -> list[str]:
        return [s.slot for s in self.by_table[target.name]]


def make_plan(vault: Vault, settings: Settings) -> Plan:
    tables = catalog_plan.catalog(vault, settings)
    rows = tables.collect()
    catalog_plan.require_tables(rows, vault, settings)
    catalog_plan.require_distinct_names(rows)
    tables = vault.spark.createDataFrame(rows, tables.schema)  # planned once
    specs = sorted(check_specs(tables, settings, vault.qualifier).collect(), key=lambda s: s.generation_order)
    targets = {
        r.table_name: Target(
            r.table_name, r.source_name, r.table_type, r.own_hk, r.load_dts_col, r.record_source_col, r.hash_diff_col,
            tuple(r.hk_columns), {}, r.columns_error,
        )
        for r in sorted(rows, key=lambda r: r.position)
    }
    by_table: dict[str, list[Row]] = {}
    for s in specs:
        by_table.setdefault(s.table_name, []).append(s)
        if s.check_id in ("L2", "L3", "S3"):
            targets[s.table_name].references[s.key_column] = s.parent_name
    numbers = {(s.table_name, s.slot): n for n, s in enumerate(specs, start=1)}
    return Plan(targets, specs, by_table, tables, numbers)


def grain_keys(target: Target, slot: str) -> list[str] | None:
    """The columns of a duplicate check."""
    return {
        "H2": [target.own_hk],
        "L4": list(target.hk_columns),
        "S2": [target.own_hk, target.load_dts],
        "S5": [target.own_hk, target.hash_diff],
    }.get(slot)


def key_of_orphans(target: Target, slot: str) -> str | None:
    """The key column of an orphan check."""
    if slot == "S3":
        return target.own_hk
    return slot.removeprefix("L3:") if slot.startswith("L3:") else None


def _long_form(df: DataFrame, target: Target, slot: Column) -> DataFrame:
    return df.select(
        F.lit(target.name).alias("table_name"),
        slot.alias("slot"),
        F.col("value").cast("bigint").alias("value"),
        F.lit(None).cast("string").alias("error"),
    )


def profile_frame(vault: Vault, target: Target, slots: Iterable[str], settings: Settings, from_footers: bool = False) -> DataFrame:
    df = vault.table(target.source_name)
    if from_footers and set(slots) <= FOOTER_SLOTS and _load_time_in_footers(df, target, slots):
        df = by_footers(df) or df
    return profile(df, target, slots, settings)


def _load_time_in_footers(df: DataFrame, target: Target, slots: Iterable[str]) -> bool:
    return not CLOCK_SLOTS.intersection(slots) or isinstance(column_type(df, target.load_dts), IN_FOOTERS)


def grain_rounds(target: Target, slots: Sequence[str], settings: Settings) -> list[list[str]]:
    """Which duplicate checks of a table share a scan: all of them, but for those by hashes first, which have rounds of their own,
    and checks whose keys are the same columns."""
    if settings.hash_first or not settings.share_grains or len({frozenset(grain_keys(target, s)) for s in slots}) < len(slots):
        return [[s] for s in slots]
    return [list(slots)] if slots else []


def grain_frame(vault: Vault, target: Target, slots: Sequence[str], settings: Settings, hash_first: bool = False) -> DataFrame:
    """Duplicate checks of a table, of one key set or several."""
    df = vault.table(target.source_name)
    if len(slots) > 1:
        return _long_form(duplicate_groups_of(df, {s: grain_keys(target, s) for s in slots}), target, F.col("slot"))
    (slot,) = slots
    keys = grain_keys(target, slot)
    if hash_first and can_hash_first(df, keys) and can_store(vault.spark):
        groups = duplicate_groups_hash_first(df, keys, settings.broadcast_key_bytes)
    else:
        groups = duplicate_groups(df, keys)
    return _long_form(groups, target, F.lit(slot))


def orphan_frame(
    vault: Vault, target: Target, slot: str, parent: Target, broadcast_parent: bool = False, broadcast_child: bool = False
) -> DataFrame:
    child = Child(target.name, slot, vault.table(target.source_name), key_of_orphans(target, slot))
    return _long_form(orphan_rows(child, vault.table(parent.source_name), broadcast_parent, broadcast_child), target, F.lit(slot))


def shared_frame(
    vault: Vault, parent: Target, key: str, children: Sequence[tuple[Target, str]], with_duplicates: bool
) -> DataFrame:
    """Orphan checks of several children of one parent, and the parent's duplicate check where it has one."""
    frames = [Child(t.name, slot, vault.table(t.source_name), key) for t, slot in children]
    figures = shared_key_figures(vault.table(parent.source_name), key, frames)
    rows = [(c.table_name, c.slot, f"orphans_{n}") for n, c in enumerate(frames, start=1)]
    if with_duplicates:
        rows.append((parent.name, "H2", "duplicate_groups"))
    return figures.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(slot).alias("slot"),
                        F.col(column).cast("bigint").alias("value"),
                        F.lit(None).cast("string").alias("error"),
                    )
                    for table, slot, column in rows
                ]
            )
        )
    )


def same_key_type(vault: Vault, parent: Target, child: Target, key: str) -> bool:
    return column_type(vault.table(parent.source_name), key) == column_type(vault.table(child.source_name), key)


def checks_of(vault: Vault, settings: Settings, checks: Collection[str], shared: bool = False) -> DataFrame:
    """table_name, slot, value, error of some checks as one lazy DataFrame: nothing but the catalog is read before it is used."""
    settings = settings.resolved(vault.spark)
    plan = make_plan(vault, settings).only(checks, None)
    return check_values(vault, plan, settings, lambda check_id: True, shared)


def check_values(
    vault: Vault, plan: Plan, settings: Settings, wanted: Callable[[str], bool], shared: bool = False
) -> DataFrame:
    """Values of the checks whose id is wanted, as one lazy DataFrame. Spark chooses the joins; `shared` groups the
    children of a parent with it instead."""
    frames = []
    children: dict[tuple[str, str], list[tuple[Target, str]]] = {}
    for target in plan.targets.values():
        slots = [s.slot for s in plan.by_table[target.name] if wanted(s.check_id)]
        grains: list[str] = []
        of_profile = [s for s in slots if s in profile_slots(target)]
        if of_profile:
            frames.append(profile_frame(vault, target, of_profile, settings))
        for slot in slots:
            if grain_keys(target, slot):
                grains.append(slot)
            elif key := key_of_orphans(target, slot):
                parent = target.references[key]
                if shared:
                    children.setdefault((parent, key), []).append((target, slot))
                else:
                    frames.append(orphan_frame(vault, target, slot, plan.targets[parent]))
        frames += [grain_frame(vault, target, together, settings) for together in grain_rounds(target, grains, settings)]
    for (parent, key), members in children.items():
        for start in range(0, len(members), settings.children_per_round):
            batch = members[start : start + settings.children_per_round]
            frames.append(shared_frame(vault, plan.targets[parent], key, batch, with_duplicates=False))
    return reduce(DataFrame.unionByName, frames)
