"""Duplicate and orphan checks against brute force."""

import random
from collections import Counter
from types import SimpleNamespace

import pytest

from tests.conftest import plan_of
from vaultgauge.functions.storage import can_store
from vaultgauge.operators.grain import can_hash_first, duplicate_groups, duplicate_groups_hash_first
from vaultgauge.operators.orphans import Child, fits_broadcast, orphan_rows, shared_key_figures


def value(df):
    return df.first().value


def frame(spark, keys, name="k"):
    return spark.createDataFrame([(k,) for k in keys], f"{name} string")


@pytest.mark.parametrize("seed", range(3))
def test_duplicates(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice([None, "a", "b", "c"]), r.choice([None, *map(str, range(40))])) for _ in range(120)]
    rows += [("hot", "1")] * 60
    df = spark.createDataFrame(rows, "a string, b string")
    expected = sum(n > 1 for n in Counter(rows).values())
    assert value(duplicate_groups(df, ["a", "b"])) == expected
    assert can_hash_first(df, ["a", "b"])
    # Many places; one bitmap of them; no first round.
    for limit in (1 << 20, 4096, 0):
        assert value(duplicate_groups_hash_first(df, ["a", "b"], limit)) == expected


def test_nulls_are_one_group_each(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), ("x", None), (None, None), (None, None)], "a string, b string")
    assert value(duplicate_groups(df, ["a", "b"])) == 2
    assert value(duplicate_groups_hash_first(df, ["a", "b"], 1 << 20)) == 2


def test_equal_hashes_are_not_equal_keys(spark):
    # A NULL leaves the hash as it is, so these two rows have the same hash.
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert df.selectExpr("xxhash64(a, b) AS h").distinct().count() == 1
    assert value(duplicate_groups_hash_first(df, ["a", "b"], 1 << 20)) == 0


def test_rows_at_a_marked_place_by_chance(spark):
    # Some duplicates among two hundred thousand keys on 32,768 places: every key has neighbours at its place.
    df = spark.range(200_000).selectExpr("string(id) AS k").union(spark.range(0, 200_000, 40_000).selectExpr("string(id) AS k"))
    assert value(duplicate_groups_hash_first(df, ["k"], 4096)) == 5


def test_bits_of_all_kinds_of_places(spark):
    # Nearly every bit of one bitmap is marked, and then every eighth duplicate stands alone at its place.
    df = spark.range(300_000).selectExpr("concat('k', id % 150000) AS k", "id % 2 AS x")
    assert value(duplicate_groups_hash_first(df, ["k"], 4096)) == 150_000
    assert value(duplicate_groups_hash_first(df, ["k", "x"], 1 << 22)) == value(duplicate_groups(df, ["k", "x"]))
    assert value(duplicate_groups_hash_first(spark.range(5000).selectExpr("id AS k"), ["k"], 1 << 22)) == 0


def test_many_duplicates_by_hashes_first(spark):
    df = spark.range(3_000_000).selectExpr("id % 2000000 AS k")
    assert value(duplicate_groups_hash_first(df, ["k"], 8 << 20)) == 1_000_000
    plan = plan_of(duplicate_groups_hash_first(df, ["k"], 8 << 20))
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "NestedLoop" not in plan


def test_no_duplicates_and_no_rows(spark):
    assert value(duplicate_groups_hash_first(frame(spark, ["a", "b", None]), ["k"], 1 << 20)) == 0
    empty = frame(spark, [])
    assert value(duplicate_groups(empty, ["k"])) == 0
    assert value(duplicate_groups_hash_first(empty, ["k"], 1 << 20)) == 0


def test_storage_needs_a_checkpoint_folder():
    def session(folder):
        return SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: folder))

    assert can_store(session("/shared")) and not can_store(session(None))


def test_floating_keys_are_not_hashed(spark):
    assert not can_hash_first(spark.range(1).selectExpr("CAST(id AS DOUBLE) AS k"), ["k"])


@pytest.mark.parametrize("seed", range(3))
def test_orphans(spark, seed):
    r = random.Random(seed)
    parents = [r.choice([None, *map(str, range(30))]) for _ in range(40)]
    children = [[r.choice([None, *map(str, range(45))]) for _ in range(80)] + ["hot"] * 40 for _ in range(2)]
    known = {p for p in parents if p is not None}
    expected = [sum(c not in known for c in keys) for keys in children]
    parent = frame(spark, parents)
    kids = [Child("C", f"S{n}", frame(spark, keys), "k") for n, keys in enumerate(children)]
    for child, n in zip(kids, expected):
        assert value(orphan_rows(child, parent)) == n
        assert value(orphan_rows(child, parent, broadcast_parent=True)) == n
    row = shared_key_figures(parent, "k", kids).first()
    assert [row.orphans_1, row.orphans_2] == expected
    assert row.duplicate_groups == sum(n > 1 for n in Counter(parents).values())


def test_empty_sides(spark):
    some, none = frame(spark, ["a", None]), frame(spark, [])
    for parent, child, orphans in ((none, some, 2), (some, none, 0), (none, none, 0)):
        kid = Child("C", "S3", child, "k")
        assert value(orphan_rows(kid, parent)) == orphans
        assert value(orphan_rows(kid, parent, True)) == orphans
        assert shared_key_figures(parent, "k", [kid]).first().orphans_1 == orphans


def test_broadcast_needs_a_measured_size():
    assert fits_broadcast(10, 320, 1000)
    assert not fits_broadcast(10, 400, 1000)
    assert not fits_broadcast(None, None, 1 << 60)
    assert not fits_broadcast(0, 0, -1)


def test_plans(spark, tmp_path):
    frame(spark, ["a"]).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    kid = Child("C", "S3", df, "k")
    small = plan_of(orphan_rows(kid, df, True)).split("\n\n")[0]
    assert "BroadcastHashJoin LeftAnti" in small and small.count("Exchange") == 2
    shared = plan_of(shared_key_figures(df, "k", [kid, kid, kid])).split("\n\n")[0]
    # One shuffle of the keys, with partial aggregation ahead of it, and one row per task to the end.
    assert shared.count("Exchange") == 2 and shared.count("HashAggregate") == 4
    assert shared.count("Scan parquet") == 4 and "Join" not in shared and "Sort" not in shared
    grain = plan_of(duplicate_groups(df, ["k"])).split("\n\n")[0]
    assert grain.count("Exchange") == 2 and grain.count("HashAggregate") == 4
