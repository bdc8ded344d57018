"""Whole runs: known totals, plans of large and small parents, single queries, isolation of errors, sources, sinks."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from vaultgauge import Settings, Vault, validate
from vaultgauge.__main__ import main as main_command
from vaultgauge.plans import runner
from vaultgauge.plans.passes import make_plan
from vaultgauge.sinks.report import run_line, write_document, write_tables
from vaultgauge.testbed import vaults

SF = f"{TESTDATA}/sf0.01"

# FIXTURES.md, values of checks that are neither 0 nor informational
KNOWN_FAILURES = {
    "HUB_CUSTOMER": {"H1": 3, "H2": 16, "V1": 1, "R1": 1},
    "HUB_ORDER": {"F1": 1},
    "HUB_USER": {"T3": 15, "F1": 1},
    "LINK_CUSTOMER_ORDER": {"L1": 20, "L2:CUSTOMER_HK": 155, "L3:CUSTOMER_HK": 198, "L4": 59, "F1": 1, "R1": 1},
    "SAT_CUSTOMER": {"S2": 15, "S3": 3, "S4": 6, "S5": 15, "T1": 5},
    "SAT_USER": {"S1": 10, "S2": 150, "S3": 186, "S5": 752, "T2": 131, "F2": 131, "V2": 1},
    "S_USER_DAILY": {"S3": 165, "V1": 1},
}
KNOWN_INFO = {
    "T4": [1515, 15000, 147, 15060, 1515, 10000, 9671, 0],
    "F3": [1, 10621, 29, 10621, 0, 29, 29, 0],
    "V3": [0, 0, 0, 0, 1510, 2747, 0, 0],
    "R2": [1, 5, 1, 2, 2, 5, 5, 0],
}


def outcomes(report):
    return {(r.table_name, r.check_name): (r.status, r.value) for r in report.results.collect()}


@pytest.fixture(scope="module")
def main(spark):
    return vaults.main_vault(spark, SF)


@pytest.fixture(scope="module")
def report(main):
    return validate(main, vaults.settings())


def test_known_values(report):
    found = {}
    for r in report.results.filter("status = 'FAIL'").collect():
        key = r.check_id
        if key in ("L2", "L3"):
            key += ":" + r.check_name.split("(")[-1].rstrip(")").split("— ")[-1].split(" not in")[0]
        found.setdefault(r.table_name, {})[key] = r.value
    assert found == KNOWN_FAILURES
    for check_id, expected in KNOWN_INFO.items():
        assert [r.value for r in report.results.filter(F.col("check_id") == check_id).orderBy("seq").collect()] == expected


def test_known_totals(report):
    t = report.totals().first()
    assert (t.checks, t["pass"], t.fail, t.error, t.info, t.dq_score) == (128, 69, 27, 0, 32, 72)
    assert (t.hub_tables, t.link_tables, t.sat_tables) == (3, 1, 4)
    assert [(r.category, r.checks, r["pass"], r.fail, r.score) for r in report.categories().collect()] == [
        ("Technical", 64, 38, 18, 68), ("Freshness", 24, 12, 4, 75), ("Volume", 24, 13, 3, 81), ("Source", 16, 6, 2, 75),
    ]
    assert [r.seq for r in report.results.orderBy("seq").collect()] == list(range(1, 129))
    assert "ORDERS_RAW" not in {r.table_name for r in report.tables().collect()}


@pytest.mark.parametrize(
    "changes",
    [
        {"broadcast_key_bytes": 0},  # children grouped with their parent
        {"broadcast_key_bytes": 0, "children_per_round": 1},
        {"hash_first": True},
        {"share_grains": False},
        {"concurrent_passes": 1},
    ],
)
def test_every_plan_has_the_same_results(main, report, changes):
    assert outcomes(validate(main, vaults.settings(**changes))) == outcomes(report)


def test_without_broadcasts(spark, main, report):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert outcomes(validate(main, vaults.settings())) == outcomes(report)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["main", "quirk"])
def test_query_text_of_each_check_gives_its_value(spark, name):
    frames = vaults.frames(spark, f"{TESTDATA}/sf0.001", {"main": vaults.MAIN_VIEWS, "quirk": vaults.QUIRK_VIEWS}[name])
    for view, df in frames.items():
        df.createOrReplaceTempView(view)
    for r in validate(Vault.from_frames(spark, frames), vaults.settings()).results.collect():
        if r.status == "ERROR":
            with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
                spark.sql(r.query_text).collect()
        else:
            assert (spark.sql(r.query_text).first()[0] or 0) == r.value, r.query_text
    for view in frames:
        spark.catalog.dropTempView(view)


def test_quirks(spark):
    report = validate(vaults.quirk_vault(spark, SF), vaults.settings())
    t = report.totals().first()
    assert (t.checks, t["pass"], t.fail, t.error, t.info, t.dq_score) == (21, 9, 2, 7, 3, 82)
    failed = {(r.table_name, r.check_id): r.value for r in report.results.filter("status = 'FAIL'").collect()}
    assert failed == {("L_ORDER_PART", "L4"): 38, ("S_ORDER", "S3"): 5175}
    errors = report.results.filter("status = 'ERROR'").collect()
    assert {r.table_name for r in errors} == {"S_ORDER"}
    assert {r.check_id for r in errors} == {"T2", "F1", "F2", "F3", "V1", "V2", "V3"}
    assert all(r.value is None and "15000 value(s)" in r.error for r in errors)
    lenient = validate(vaults.quirk_vault(spark, SF), vaults.settings(lenient_timestamps=True))
    assert lenient.totals().first().error == 0


HUB = "a_hk string, load_dts timestamp, record_source string"


def test_unreadable_table_spoils_its_own_checks_only(spark, settings, tmp_path):
    hub = spark.createDataFrame([("k", None, "s")], HUB)
    hub.write.parquet(str(tmp_path / "hub"))
    (tmp_path / "sat").mkdir()
    (tmp_path / "sat" / "part.parquet").write_bytes(b"no parquet")
    bad = spark.read.schema(HUB).parquet(str(tmp_path / "sat"))
    vault = Vault.from_frames(spark, {"hub_a": spark.read.parquet(str(tmp_path / "hub")), "sat_a": bad})
    found = outcomes(validate(vault, settings))
    assert {status for (table, _), (status, _) in found.items() if table == "SAT_A"} == {"ERROR"}
    assert "ERROR" not in {status for (table, _), (status, _) in found.items() if table == "HUB_A"}


def test_table_without_readable_columns(spark, settings, tmp_path):
    spark.createDataFrame([("k", None, "s")], HUB).write.parquet(str(tmp_path / "hub"))
    vault = Vault.from_paths(spark, {"hub_a": str(tmp_path / "hub"), "sat_a": str(tmp_path / "nothing")})
    results = validate(vault, settings).results.collect()
    assert [(r.check_id, r.status) for r in results if r.table_name == "SAT_A"] == [("T4", "ERROR")]
    assert "PATH_NOT_FOUND" in [r.error for r in results if r.table_name == "SAT_A"][0]
    assert all(r.status != "ERROR" for r in results if r.table_name == "HUB_A")


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_missing_parent_spoils_the_orphan_check_only(spark, settings, limit):
    sat = spark.createDataFrame([("k", None, "s")], HUB)

    def open_table(name):
        if name == "hub_a":
            raise ValueError("gone")
        return sat

    vault = Vault(spark, ["hub_a", "sat_a"], open_table, lambda name: ["a_hk", "load_dts", "record_source"])
    results = validate(vault, replace(settings, broadcast_key_bytes=limit)).results.collect()
    assert all(r.status == "ERROR" and "gone" in r.error for r in results if r.table_name == "HUB_A")
    assert {r.check_id for r in results if r.table_name == "SAT_A" and r.status == "ERROR"} == {"S3"}


def test_ambiguous_column_spoils_the_checks_on_it(spark, settings):
    df = spark.range(3).selectExpr("'k' AS a_hk", "'s' AS record_source", "'t' AS RECORD_SOURCE")
    results = validate(Vault.from_frames(spark, {"hub_a": df}), settings).results.collect()
    assert {r.check_id for r in results if r.status == "ERROR"} == {"T3", "R1", "R2"}
    assert {r.check_id: r.value for r in results if r.status != "ERROR"} == {"H1": 0, "H2": 1, "T4": 3}


def test_keys_of_different_types(spark, settings):
    hub = spark.createDataFrame([(1,), (2,)], "a_hk bigint")
    sat = spark.createDataFrame([("1",), ("3",), (None,)], "a_hk string")
    vault = Vault.from_frames(spark, {"hub_a": hub, "sat_a": sat})
    for limit in (1 << 20, 0):
        found = outcomes(validate(vault, replace(settings, broadcast_key_bytes=limit)))
        assert found["SAT_A", "Orphan records — A_HK not in HUB_A"] == ("FAIL", 2)


def test_odd_names(spark, settings):
    df = spark.createDataFrame([("k", "s"), (None, "s")], "`my key.x_hk` string, `the source` string")
    found = outcomes(validate(Vault.from_frames(spark, {"hub_é x": df}), settings))
    assert found["HUB_É X", "NULL hash key (MY KEY.X_HK)"] == ("FAIL", 1)
    assert "ERROR" not in {status for status, _ in found.values()}


def test_large_parents_share_one_shuffle_and_small_ones_are_broadcast(main):
    s = vaults.settings().resolved(main.spark)
    plan = make_plan(main, s)
    sizes = {(n, what): (1000, None) for n in plan.targets for what in ("rows", "key_bytes")}
    small = runner._key_passes(main, plan, s, sizes)
    assert sorted(len(p.slots) for p in small) == [1] * 10 + [2] * 4  # H2 3, L3 2, L4 1, S3 4; S2 and S5 4
    apart = runner._key_passes(main, plan, replace(s, share_grains=False), sizes)
    assert sorted(len(p.slots) for p in apart) == [1] * 18
    large = runner._key_passes(main, plan, replace(s, broadcast_key_bytes=10), sizes)
    assert sorted(sorted(slot for _, slot in p.slots) for p in large if len({t for t, _ in p.slots}) > 1) == [
        ["H2", "L3:CUSTOMER_HK", "S3"], ["H2", "L3:ORDER_HK", "S3"], ["H2", "S3", "S3"],
    ]
    unknown = runner._key_passes(main, plan, s, {})
    assert len(unknown) == len(large)


def test_database(spark, settings, tmp_path):
    spark.sql(f"CREATE DATABASE raw_vault LOCATION '{tmp_path}'")
    spark.createDataFrame([("k", None, "s"), ("k", None, "s")], HUB).write.saveAsTable("raw_vault.HUB_A")
    spark.createDataFrame([("k", 1), ("l", 2)], "a_hk string, day int").write.partitionBy("day").saveAsTable("raw_vault.sat_a")
    spark.createDataFrame([(1,)], "a int").write.saveAsTable("raw_vault.other")
    spark.range(1).createOrReplaceTempView("hub_temporary")
    try:
        report = validate(Vault.from_database(spark, "raw_vault"), replace(settings, database="raw_vault"))
        found = outcomes(report)
        assert found["HUB_A", "Duplicate hash key (A_HK)"] == ("FAIL", 1)
        assert found["SAT_A", "Orphan records — A_HK not in HUB_A"] == ("FAIL", 1)
        assert {table for table, _ in found} == {"HUB_A", "SAT_A"}
        for r in report.results.collect():
            assert (spark.sql(r.query_text).first()[0] or 0) == r.value
        assert report.header().first().report_title == "RAW_VAULT"
    finally:
        spark.sql("DROP DATABASE raw_vault CASCADE")


def test_command(spark, tmp_path, capsys):
    spark.sql(f"CREATE DATABASE vault_of_command LOCATION '{tmp_path / 'db'}'")
    spark.createDataFrame([("k", None, "s"), (None, None, "s")], HUB).write.saveAsTable("vault_of_command.hub_a")
    try:
        out = tmp_path / "out"
        main_command(["--database", "vault_of_command", "--output", str(out), "--stale-hours", "6", "--as-of", "2024-01-30"])
        printed = capsys.readouterr().out
        assert "vault_of_command.json" in printed and "of 14 checks on 1 tables (1 HUB / 0 LINK / 0 SAT)" in printed
        document = json.loads(spark.read.text(f"{out}/dv_validation_report_vault_of_command.json").first().value)
        assert document["schema_label"] == "vault_of_command" and document["report_title"] == "VAULT_OF_COMMAND"
        names = {r.check_name for r in spark.read.parquet(f"{out}/check_results").collect()}
        assert "No new records in last 6h (stale pipeline)" in names
    finally:
        spark.sql("DROP DATABASE vault_of_command CASCADE")


def test_paths(spark, settings, tmp_path):
    df = spark.createDataFrame([("k", None, "s")], HUB)
    df.write.orc(str(tmp_path / "h"))
    found = outcomes(validate(Vault.from_paths(spark, {"hub_a": str(tmp_path / "h")}, "orc"), settings))
    assert found["HUB_A", "Total row count"] == ("INFO", 1)


def test_clock_is_read_once(spark):
    s = Settings().resolved(spark)
    assert s.resolved(spark).as_of == s.as_of
    assert spark.sql(f"SELECT abs(unix_seconds(current_timestamp()) - unix_seconds({s.now})) < 60").first()[0]
    import datetime as dt

    aware = dt.datetime(2024, 1, 30, 13, 30, tzinfo=dt.timezone(dt.timedelta(hours=1, minutes=30)))
    assert Settings(as_of=aware).resolved(spark).as_of == "2024-01-30 12:00:00"
    assert Settings(as_of=dt.datetime(2024, 1, 30, 12)).resolved(spark).as_of == "2024-01-30 12:00:00"


def test_sinks(spark, report, tmp_path):
    path = write_document(report, str(tmp_path))
    assert path.endswith("/dv_validation_report_main_vault_1.json")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 1 and json.loads(lines[0])["dq_score"] == 72
    write_tables(report, str(tmp_path / "tables"))
    results = spark.read.parquet(str(tmp_path / "tables/check_results"))
    assert results.count() == 128 and str(results.first().run_date) == "2024-01-30"
    assert spark.read.parquet(str(tmp_path / "tables/failures")).count() == 27
    assert spark.read.parquet(str(tmp_path / "tables/table_summary")).count() == 8
    write_tables(report, str(tmp_path / "json"), "json")
    assert spark.read.json(str(tmp_path / "json/category_summary")).count() == 4
    assert run_line(report) == (
        "Score 72% | PASS=69 FAIL=27 ERROR=0 INFO=32 of 128 checks on 8 tables (3 HUB / 1 LINK / 4 SAT)"
    )


def listing_fails(vault, name, times):
    """The same vault, whose columns of one table cannot be listed so many times."""
    original, left = vault._column_names, {"n": times}

    def column_names(table):
        if table == name and left["n"]:
            left["n"] -= 1
            raise RuntimeError("throttled")
        return original(table)

    return Vault(vault.spark, vault.names, vault._open, column_names)


def test_failed_listing_is_an_error(main, report):
    broken = validate(listing_fails(main, "hub_user", 99), vaults.settings())
    rows = [r for r in broken.results.collect() if r.table_name == "HUB_USER"]
    assert [(r.check_id, r.status) for r in rows] == [("T4", "ERROR")] and "throttled" in rows[0].error
    assert broken.totals().first().error >= 1
    assert outcomes(validate(listing_fails(main, "hub_user", 1), vaults.settings())) == outcomes(report)  # a second attempt helps


def test_storage_that_fails_costs_no_check(main, report, monkeypatch):
    from vaultgauge.operators import grain

    def fails(df):
        raise OSError("no such folder")

    monkeypatch.setattr(grain, "stored", fails)
    t = validate(main, vaults.settings(hash_first=True)).totals().first()
    assert (t["pass"], t.fail, t.error, t.dq_score) == (69, 27, 0, 72)


def test_multi_part_database(spark, settings, tmp_path):
    spark.sql(f"CREATE DATABASE parts LOCATION '{tmp_path}'")
    spark.createDataFrame([("k", None, "s"), ("k", None, "s")], HUB).write.saveAsTable("parts.hub_a")
    try:
        plain = validate(Vault.from_database(spark, "parts"), settings)
        for name in ("spark_catalog.parts", ["spark_catalog", "parts"]):
            named = validate(Vault.from_database(spark, name), settings)
            assert outcomes(named) == outcomes(plain)
            for r in named.results.collect():
                assert (spark.sql(r.query_text).first()[0] or 0) == r.value
    finally:
        spark.sql("DROP DATABASE parts CASCADE")


def test_some_checks_and_tables(main, report):
    some = validate(main, vaults.settings(), checks=["S3", "H2"], tables=["sat_user", "HUB_USER"])
    assert {(r.table_name, r.check_id) for r in some.results.collect()} == {("SAT_USER", "S3"), ("HUB_USER", "H2")}
    whole = {(r.table_name, r.check_id): r.value for r in report.results.collect()}
    assert all(whole[r.table_name, r.check_id] == r.value for r in some.results.collect())
    with pytest.raises(ValueError, match="X9"):
        validate(main, vaults.settings(), checks=["X9"])


def test_diagnostics_of_a_run(report):
    found = {r.table_name: r.missing for r in report.diagnostics().collect()}
    assert len(found) == 8 and "LOAD_DTS" not in found["HUB_CUSTOMER"]


def test_names_that_differ_by_case_are_refused(spark, settings):
    df = spark.createDataFrame([("k", None, "s")], HUB)
    with pytest.raises(ValueError, match="case"):
        validate(Vault.from_frames(spark, {"hub_a": df, "HUB_A": df}), settings)
