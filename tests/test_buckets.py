"""Tables bucketed by their keys: no shuffle where buckets match, the plans of other tables where they don't."""

from dataclasses import replace

import pytest

from tests.conftest import TESTDATA
from tests.test_run import outcomes
from vaultgauge import Vault, validate
from vaultgauge.plans import buckets, runner
from vaultgauge.plans.passes import make_plan
from vaultgauge.testbed import vaults

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def bucketed(spark):
    with vaults.bucketed_main_vault(spark, SF) as vault:
        yield vault


@pytest.fixture
def large(settings):
    """Settings with which no parent or child is small."""
    return replace(settings, broadcast_key_bytes=0)


def passes(vault, settings):
    """The key passes of a vault whose tables all have rows, by their slots: whether each moves rows by key, and its plan."""
    plan = make_plan(vault, settings)
    sizes = {(n, what): (1000, None) for n in plan.targets for what in ("rows", "key_bytes")}
    found = {}
    for one in runner._key_passes(vault, plan, settings, sizes):
        frame = one.frame(one.slots)
        found[frozenset(f"{table}.{slot}" for table, slot in one.slots)] = (
            buckets.moves_rows(frame), frame._jdf.queryExecution().executedPlan().toString(),
        )
    return found


def moving(found):
    return {"+".join(sorted(slots)) for slots, (moves, _) in found.items() if moves}


def test_keys_in_matching_buckets_need_no_shuffle(bucketed, large):
    found = passes(bucketed, large)
    # The link is bucketed by one of its two keys.
    assert moving(found) == {"LINK_CUSTOMER_ORDER.L3:ORDER_HK"}
    assert frozenset({"HUB_USER.H2", "SAT_USER.S3", "S_USER_DAILY.S3"}) in found
    assert frozenset({"HUB_CUSTOMER.H2", "SAT_CUSTOMER.S3", "LINK_CUSTOMER_ORDER.L3:CUSTOMER_HK"}) in found
    in_place = [plan for moves, plan in found.values() if not moves]
    assert in_place and all("Bucketed: true" in plan for plan in in_place)
    assert all("Bucketed: true" not in plan for moves, plan in found.values() if moves)
    assert {frozenset({c}) for c in ("SAT_USER.S2", "SAT_USER.S5", "LINK_CUSTOMER_ORDER.L4")} <= found.keys()


def test_values_are_those_of_other_tables(spark, bucketed, large):
    plain = outcomes(validate(vaults.main_vault(spark, SF), vaults.settings()))
    for changes in ({"broadcast_key_bytes": 0}, {"broadcast_key_bytes": 0, "use_buckets": False}, {}):
        assert outcomes(validate(bucketed, vaults.settings(**changes))) == plain


def test_switched_off(bucketed, large):
    found = passes(bucketed, replace(large, use_buckets=False))
    assert all("Bucketed: true" not in plan for _, plan in found.values())
    assert frozenset({"SAT_USER.S2", "SAT_USER.S5"}) in found  # one scan for both, as there is a shuffle anyway


def test_hot_bucket_is_read_by_files(bucketed, large):
    # Every bucket counts as hot: the plans of tables without buckets.
    found = passes(bucketed, replace(large, hot_bucket_bytes=0, hot_bucket_factor=0.5))
    of_rows = {slots: plan for slots, plan in found.items() if not any("EMPTY" in s for s in slots)}  # a table without files has no bucket
    assert all(moves and "Bucketed: true" not in plan for moves, plan in of_rows.values())
    assert of_rows.keys() <= passes(bucketed, replace(large, use_buckets=False)).keys()


def test_size_of_buckets(spark, settings):
    spark.sql("CREATE DATABASE sizes")
    try:
        spark.range(40_000).selectExpr("IF(id % 2 = 0, 'hot', md5(string(id))) AS a_hk", "sha2(string(id), 256) AS x").write.bucketBy(8, "a_hk").saveAsTable("sizes.sat_a")
        spark.range(40_000).selectExpr("md5(string(id)) AS a_hk", "sha2(string(id), 256) AS x").write.bucketBy(8, "a_hk").saveAsTable("sizes.hub_a")
        hot, even = spark.table("sizes.sat_a"), spark.table("sizes.hub_a")
        small = replace(settings, hot_bucket_bytes=100_000)
        assert buckets.has_hot_bucket(hot, small) and not buckets.has_hot_bucket(even, small)
        assert not buckets.has_hot_bucket(hot, settings)  # uneven, but no task would take long
        assert not buckets.has_hot_bucket(spark.range(3), small)
    finally:
        spark.sql("DROP DATABASE sizes CASCADE")


def test_other_numbers_of_buckets_are_shuffled(spark, large):
    spark.sql("CREATE DATABASE uneven")
    try:
        spark.range(100).selectExpr("md5(string(id)) AS a_hk").write.bucketBy(4, "a_hk").saveAsTable("uneven.hub_a")
        for name, count in (("sat_b", 4), ("sat_c", 6)):
            spark.range(150).selectExpr("md5(string(id)) AS a_hk").write.bucketBy(count, "a_hk").saveAsTable(f"uneven.{name}")
        spark.range(120).selectExpr("md5(string(id)) AS a_hk").write.saveAsTable("uneven.sat_d")
        vault = Vault.from_database(spark, "uneven")
        found = passes(vault, large)
        assert {"+".join(sorted(slots)): moves for slots, (moves, _) in found.items()} == {"HUB_A.H2+SAT_B.S3": False, "SAT_C.S3+SAT_D.S3": True}
        results = {(r.table_name, r.check_id): r.value for r in validate(vault, large).results.collect()}
        assert [results[t, "S3"] for t in ("SAT_B", "SAT_C", "SAT_D")] == [50, 50, 20] and results["HUB_A", "H2"] == 0
    finally:
        spark.sql("DROP DATABASE uneven CASCADE")


def test_settings_of_the_session_hold_without_buckets_too(spark, bucketed):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        vault = Vault.from_database(spark, bucketed.qualifier)
        session = vault.unbucketed.spark
        assert session.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert session.conf.get("spark.sql.sources.bucketing.enabled") == "false"
        assert spark.conf.get("spark.sql.sources.bucketing.enabled") == "true"
        assert vault.unbucketed is vault.unbucketed and Vault.from_frames(spark, {}).unbucketed.spark is spark
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
