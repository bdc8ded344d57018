"""Run all checks of a vault.

Tables are profiled first, one scan each. Their measured sizes then choose the plan of the key checks. Passes are
independent Spark jobs; some run at a time, so that the tail of one leaves no executors idle. What comes back is one
short row per check. A pass that fails is halved until the checks that spoil it are alone, so an unreadable column or table
spoils its own checks only.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Collection, Sequence
from functools import reduce
from queue import Empty, Queue
from typing import NamedTuple

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultgauge.operators.orphans import fits_broadcast
from vaultgauge.operators.partials import profile_of_partials
from vaultgauge.operators.profile import FOOTER_SLOTS, KEY_BYTES, ROWS, SOURCE_SLOTS, profile_slots
from vaultgauge.operators.target import Target
from vaultgauge.plans import summary
from vaultgauge.plans.catalog import diagnostics
from vaultgauge.plans.buckets import has_hot_bucket, moves_rows
from vaultgauge.plans.incremental import KeptPartials
from vaultgauge.plans.isolation import Outcome, Run, Slot, Stopped, outcomes_of
from vaultgauge.plans.passes import (
    Plan, grain_frame, grain_keys, grain_rounds, key_of_orphans, make_plan, orphan_frame, profile_frame, same_key_type, shared_frame,
)
from vaultgauge.plans.verdict import with_status
from vaultgauge.settings import Settings
from vaultgauge.sources.vault import Vault


# Seconds between looks at the clock, where passes have a time limit, and those that a stopped pass is given to end.
POLL_SECONDS = 0.2
GRACE_SECONDS = 10.0


class Pass(NamedTuple):
    """Checks that share a job."""

    slots: list[Slot]
    frame: Callable[[Sequence[Slot]], DataFrame]  # of these slots or some of them
    alone: Callable[[Sequence[Slot]], DataFrame] | None = None  # another plan for one of them, where the first one fails


class Scope(NamedTuple):
    """The checks and tables that a run was asked for; None: all."""

    checks: tuple[str, ...] | None = None
    tables: tuple[str, ...] | None = None

    @property
    def is_everything(self) -> bool:
        return self.checks is None and self.tables is None

    def covers(self) -> Column:
        """Whether a result is one that the run gives, or would have given if its table still had the check."""
        within = [F.col(name).isin(*given) for name, given in (("check_id", self.checks), ("table_name", self.tables)) if given is not None]
        return reduce(Column.__and__, within, F.lit(True))


class Report:
    """Results of one run. Every summary is a DataFrame over the results, which are kept."""

    def __init__(self, results: DataFrame, settings: Settings, tables: DataFrame | None = None, scope: Scope = Scope()):
        self.results = results
        self.settings = settings
        self.catalog = tables
        self.scope = scope

    def diagnostics(self) -> DataFrame:
        """Per table the audit columns that the naming rules found, and those that they did not: the main reason for too few checks."""
        return diagnostics(self.catalog)

    def totals(self) -> DataFrame:
        return summary.run_totals(self.results)

    def categories(self) -> DataFrame:
        return summary.category_summary(self.results)

    def tables(self) -> DataFrame:
        return summary.table_summary(self.results)

    def failures(self) -> DataFrame:
        return summary.failures(self.results)

    def ordered(self) -> DataFrame:
        return summary.results_ordered(self.results)

    def header(self) -> DataFrame:
        return summary.report_header(self.results, self.settings)

    def document(self) -> DataFrame:
        return summary.summary_json(self.results, self.settings)


def validate(
    vault: Vault,
    settings: Settings | None = None,
    checks: Collection[str] | None = None,
    tables: Collection[str] | None = None,
) -> Report:
    """Runs the checks of a vault: all of them, or those with the given ids, of all tables or of those named (in any case)."""
    settings = (settings or Settings()).resolved(vault.spark)
    plan = make_plan(vault, settings).only(checks, tables)
    scope = Scope(None if checks is None else tuple(checks), None if tables is None else tuple(t.upper() for t in tables))
    outcomes: dict[Slot, Outcome] = {}
    _run(vault.spark, _profile_passes(vault, plan, settings), settings, outcomes)
    _run(vault.spark, _key_passes(vault, plan, settings, outcomes), settings, outcomes)
    return Report(_results(vault.spark, plan, outcomes), settings, plan.catalog, scope)


def _profile_passes(vault: Vault, plan: Plan, settings: Settings) -> list[Pass]:
    parents = {parent for t in plan.targets.values() for parent in t.references.values()}
    kept = KeptPartials(vault, settings)
    passes = []
    for target in plan.targets.values():
        orphan_keys = {key for s in plan.slots(target) if (key := key_of_orphans(target, s))}
        slots = [s for s in plan.slots(target) if s in profile_slots(target)]
        sizes = [ROWS, *([KEY_BYTES] if target.name in parents else []), *(f"{KEY_BYTES}:{key}" for key in sorted(orphan_keys))]
        of_sources = [s for s in slots if s in SOURCE_SLOTS]  # two columns, grouped by one of them: a pass of its own
        passes.append(_profile_pass(vault, target, [s for s in slots if s not in of_sources], sizes, settings, kept))
        if of_sources:
            passes.append(_profile_pass(vault, target, of_sources, [], settings, kept))
    return passes


def _profile_pass(vault: Vault, target: Target, slots: list[str], sizes: list[str], settings: Settings, kept: KeptPartials) -> Pass:
    """Checks of a table's own rows: from partial results, from footers where they suffice, or from the rows."""

    def frame(wanted: Sequence[Slot]) -> DataFrame:
        asked = [s for _, s in wanted]
        if (groups := kept.of(target)) is not None:
            return profile_of_partials(vault.table(target.source_name), groups, target, asked, settings)
        return profile_frame(vault, target, asked, settings, from_footers=set(slots) <= FOOTER_SLOTS)

    def of_rows(wanted: Sequence[Slot]) -> DataFrame:
        return profile_frame(vault, target, [s for _, s in wanted], settings)

    return Pass([(target.name, s) for s in slots + sizes], frame, of_rows if set(slots) <= FOOTER_SLOTS else None)


def _key_passes(vault: Vault, plan: Plan, settings: Settings, outcomes: dict[Slot, Outcome]) -> list[Pass]:
    """Duplicate and orphan checks.

    Orphans of a small parent: broadcast anti join, one per child, no shuffle of the child. Of a small child: its keys are
    broadcast to the parent, which isn't shuffled; of an empty one: 0, without a job. Of any other parent: all children and
    the parent in one grouping by key, which also finds the parent's duplicate keys; children in the same buckets as their parent
    have one of their own, which moves no rows.
    """
    limit = settings.broadcast_key_bytes
    if vault.spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        limit = -1  # broadcasts are switched off in this session

    def measured(table, what):
        return outcomes.get((table, what), (None, None))[0]

    # By tables; asked once each.
    hot: dict[str, bool] = {}

    def stays(frame: Callable[[], DataFrame], *tables: Target) -> bool:
        """Whether a plan over tables goes bucket by bucket, without moving rows, and none of their buckets is hot."""
        if not settings.use_buckets or not all(vault.is_bucketed(t.source_name) for t in tables) or moves_rows(frame()):
            return False
        for t in tables:
            if t.name not in hot:
                hot[t.name] = has_hot_bucket(vault.table(t.source_name), settings)
        return not any(hot[t.name] for t in tables)

    def by_files(*tables: Target) -> Vault:
        """Where plans that move rows read tables from: a bucketed scan would read each bucket in one task."""
        return vault.unbucketed if any(vault.is_bucketed(t.source_name) for t in tables) else vault

    def grain_passes(target: Target, slots: list[str]) -> list[Pass]:
        """Checks whose keys contain the bucket key stay in their buckets, one by one; the others share a scan and a shuffle."""
        in_place = [s for s in slots if _safe(stays, lambda s=s: grain_frame(vault, target, [s], settings), target)]
        passes = [grain_pass(target, [s], vault) for s in in_place]
        others = [s for s in slots if s not in in_place]
        return passes + [grain_pass(target, some, by_files(target)) for some in grain_rounds(target, others, settings)]

    def grain_pass(target: Target, slots: list[str], source: Vault) -> Pass:
        def frame(hash_first: bool) -> Callable[[Sequence[Slot]], DataFrame]:
            return lambda wanted: grain_frame(source, target, [s for _, s in wanted], settings, hash_first)

        own = [(target.name, s) for s in slots]
        return Pass(own, frame(True), frame(False)) if settings.hash_first else Pass(own, frame(False))

    def orphan_pass(target: Target, slot: str, parent: Target, broadcast_parent: bool = False, broadcast_child: bool = False) -> Pass:
        source = by_files(target, parent)
        return Pass(
            [(target.name, slot)], lambda wanted: orphan_frame(source, target, slot, parent, broadcast_parent, broadcast_child)
        )

    def shared_pass(parent: Target, key: str, members: list[tuple[Target, str]], hub: Target | None, source: Vault) -> Pass:
        def shared(wanted: Sequence[Slot]) -> DataFrame:
            batch = [(t, slot) for t, slot in members if (t.name, slot) in wanted]
            if batch and (len(wanted) > 1 or len(members) == 1):
                return shared_frame(source, parent, key, batch, with_duplicates=(parent.name, "H2") in wanted)
            return single(wanted)

        def single(wanted: Sequence[Slot]) -> DataFrame:
            ((name, slot),) = wanted
            if slot == "H2":
                return grain_frame(source, parent, ["H2"], settings)
            return orphan_frame(source, plan.targets[name], slot, parent)

        return Pass([(t.name, slot) for t, slot in members] + ([(hub.name, "H2")] if hub else []), shared, single)

    def of_no_rows(target: Target, slot: str) -> bool:
        """Without rows there is no duplicate; without rows of its own a table has no orphan. Parents must be readable, though."""
        if measured(target.name, ROWS) != 0:
            return False
        outcomes[(target.name, slot)] = (0, None)
        return True

    passes: list[Pass] = []
    duplicates_of_hubs: dict[str, Target] = {}
    children: dict[tuple[str, str, bool], list[tuple[Target, str]]] = {}
    for target in plan.targets.values():
        duplicates: list[str] = []
        for slot in plan.slots(target):
            if slot == "H2":
                duplicates_of_hubs[target.name] = target
            elif grain_keys(target, slot):
                if not of_no_rows(target, slot):
                    duplicates.append(slot)
            elif key := key_of_orphans(target, slot):
                parent = plan.targets[target.references[key]]
                if measured(parent.name, ROWS) is not None and of_no_rows(target, slot):
                    continue
                if fits_broadcast(measured(parent.name, ROWS), measured(parent.name, KEY_BYTES), limit):
                    passes.append(orphan_pass(target, slot, parent, broadcast_parent=True))
                elif fits_broadcast(measured(target.name, ROWS), measured(target.name, f"{KEY_BYTES}:{key}"), limit):
                    passes.append(orphan_pass(target, slot, parent, broadcast_child=True))
                elif _safe(same_key_type, vault, parent, target, key):
                    in_place = _safe(
                        stays, lambda p=parent, t=target, k=key, s=slot: shared_frame(vault, p, k, [(t, s)], False), parent, target
                    )
                    children.setdefault((parent.name, key, in_place), []).append((target, slot))
                else:
                    passes.append(orphan_pass(target, slot, parent))
        passes += grain_passes(target, duplicates)

    # Children in the buckets of their parent come first, so the parent's own duplicates are found there as well.
    for (parent_name, key, in_place), members in sorted(children.items(), key=lambda c: not c[0][2]):
        parent = plan.targets[parent_name]
        for start in range(0, len(members), settings.children_per_round):
            batch = members[start : start + settings.children_per_round]
            hub = duplicates_of_hubs.pop(parent_name, None)
            passes.append(shared_pass(parent, key, batch, hub, vault if in_place else by_files(parent, *[t for t, _ in batch])))
    for hub in duplicates_of_hubs.values():
        passes += grain_passes(hub, ["H2"])
    # The longest first, so that none of them is left for the end.
    return sorted(passes, key=lambda p: -sum(measured(table, ROWS) or 0 for table, _ in p.slots))


def _safe(predicate: Callable[..., bool], *args) -> bool:
    try:
        return predicate(*args)
    except Exception:  # the pass itself will report it
        return False


def _run(spark: SparkSession, passes: list[Pass], settings: Settings, outcomes: dict[Slot, Outcome]) -> None:
    """Runs passes as concurrent jobs, concurrent_passes at a time.

    Each has a pool of its own, which share the executors evenly where spark.scheduler.mode is FAIR, and a tag. A pass that takes
    longer than pass_seconds is stopped by its tag; one that doesn't stop even then, as it hangs outside of any job, is left to
    itself. Its checks are errors that say so, and the others go on.
    """
    waiting, running, done = deque(enumerate(passes)), {}, Queue()
    run_tag = uuid.uuid4().hex

    def start(number: int, one: Pass) -> None:
        tag = f"vaultgauge-{run_tag}-{number}"

        def work() -> None:
            try:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"pass-{number}")
                spark.sparkContext.setJobDescription(", ".join(f"{table}.{slot}" for table, slot in one.slots))
                spark.sparkContext.addJobTag(tag)
                spark.sparkContext.setInterruptOnCancel(True)
                done.put((number, _run_pass(one, settings, stopped)))
            except BaseException as e:  # a pass always has an outcome
                done.put((number, {slot: (None, str(e)) for slot in one.slots}))

        stopped = threading.Event()
        running[number] = _Running(one, tag, time.monotonic(), stopped)
        # Wrapped once per pass: each thread needs its own copy of the job properties.
        threading.Thread(target=inheritable_thread_target(spark)(work), daemon=True, name=tag).start()

    while waiting or running:
        while waiting and len(running) < settings.concurrent_passes:
            start(*waiting.popleft())
        number, found = _next_done(done, spark, running, settings)
        if number in running:  # else it came back after it had been left
            outcomes.update(found)
            del running[number]


class _Running(NamedTuple):
    one: Pass
    tag: str
    since: float
    stopped: threading.Event


def _next_done(done: Queue, spark: SparkSession, running: dict[int, _Running], settings: Settings) -> tuple[int, dict[Slot, Outcome]]:
    """The next pass that ends, or that has neither ended nor stopped in time."""
    while True:
        try:
            return done.get(timeout=None if settings.pass_seconds is None else POLL_SECONDS)
        except Empty:
            for number, r in running.items():
                late = time.monotonic() - r.since - settings.pass_seconds
                if late > 0:
                    r.stopped.set()
                    spark.sparkContext.cancelJobsWithTag(r.tag)
                if late > GRACE_SECONDS:
                    return number, {slot: (None, _too_long(settings)) for slot in r.one.slots}


def _too_long(settings: Settings) -> str:
    return f"PASS_STOPPED: it took longer than {settings.pass_seconds:g} seconds"


def _run_pass(one: Pass, settings: Settings, stopped: threading.Event) -> dict[Slot, Outcome]:
    def values(frame: Callable[[Sequence[Slot]], DataFrame]) -> Run:
        def run(slots: Sequence[Slot]) -> dict[Slot, Outcome]:
            try:
                if not stopped.is_set():
                    return {(r.table_name, r.slot): (r.value, r.error) for r in frame(slots).collect()}
            except Exception:
                if not stopped.is_set():
                    raise
            raise Stopped(_too_long(settings))

        return run

    return outcomes_of(one.slots, values(one.frame), one.frame, one.alone and values(one.alone))


def _results(spark: SparkSession, plan: Plan, outcomes: dict[Slot, Outcome]) -> DataFrame:
    schema = pa.schema(
        [
            ("seq", pa.int64()), ("category", pa.string()), ("table_name", pa.string()), ("table_type", pa.string()),
            ("check_id", pa.string()), ("slot", pa.string()), ("check_name", pa.string()), ("kind", pa.string()), ("impact", pa.string()),
            ("query_text", pa.string()), ("value", pa.int64()), ("error", pa.string()),
        ]
    )
    rows = []
    for spec in plan.specs:
        value, error = outcomes[(spec.table_name, spec.slot)]
        if unlisted := plan.targets[spec.table_name].columns_error:
            value, error = None, unlisted  # the checks that its columns would have had are missing: never a quiet success
        given = {name: spec[name] for name in schema.names if name in spec}
        rows.append({**given, "seq": plan.numbers[spec.table_name, spec.slot], "value": value, "error": error})
    return with_status(spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema)))
