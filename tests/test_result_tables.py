"""Result tables: what a write replaces, what it keeps, and writers that are lost halfway."""

import pytest

from vaultgauge import Settings, Vault, validate
from vaultgauge.sinks import report as sink
from vaultgauge.sinks.report import finish_writes, partition_name, write_tables

HUB = "a_hk string, load_dts timestamp, record_source string"
TABLES = ("check_results", "category_summary", "table_summary", "failures", "diagnostics")


def vault_of(spark, keys, satellite=None):
    frames = {"hub_a": spark.createDataFrame([(k, None, "s") for k in keys], HUB)}
    if satellite is not None:
        frames["sat_a"] = spark.createDataFrame([(k, None, "s") for k in satellite], HUB)
    return Vault.from_frames(spark, frames)


def run(vault, folder, as_of="2024-01-02 10:00:00", database="a", file_format="parquet", **only):
    report = validate(vault, Settings(database=database, as_of=as_of), **only)
    write_tables(report, str(folder), file_format)
    return report


def rows(spark, folder, name, file_format="parquet"):
    return spark.read.format(file_format).load(f"{folder}/{name}")


def statuses(spark, folder):
    return {(r.table_name, r.check_id): (r.status, str(r.run_ts)) for r in rows(spark, folder, "check_results").collect()}


def test_result_tables_keep_other_runs(spark, tmp_path):
    vault = vault_of(spark, ["k"])
    for database, moment in (("a", "2024-01-01 10:00:00"), ("a", "2024-01-02 10:00:00"), ("b", "2024-01-02 10:00:00"), ("a", "2024-01-02 10:00:00")):
        run(vault, tmp_path, moment, database)
    results = spark.read.parquet(str(tmp_path / "check_results"))
    found = {(r.database, str(r.run_date), str(r.run_ts)): r["count"] for r in results.groupBy("database", "run_date", "run_ts").count().collect()}
    assert found == {
        ("a", "2024-01-01", "2024-01-01 10:00:00"): 14, ("a", "2024-01-02", "2024-01-02 10:00:00"): 14,
        ("b", "2024-01-02", "2024-01-02 10:00:00"): 14,
    }
    assert spark.read.parquet(str(tmp_path / "diagnostics")).count() == 3


def test_a_clean_run_replaces_the_failures_of_one_before(spark, tmp_path):
    run(vault_of(spark, [None, "k", "k"]), tmp_path, "2024-01-01 09:00:00")
    run(vault_of(spark, [None, "k", "k"]), tmp_path)
    run(vault_of(spark, [None]), tmp_path, database="b")
    failed = rows(spark, tmp_path, "failures")
    assert failed.where("database = 'a' AND run_date = '2024-01-02'").count() > 0
    other_days = {name: rows(spark, tmp_path, name).where("run_date < '2024-01-02' OR database = 'b'").collect() for name in TABLES}
    clean = spark.createDataFrame([("k", "2024-01-02 08:00:00", "s"), ("l", "2024-01-02 08:00:00", "t")], "a_hk string, t string, s string")
    clean = Vault.from_frames(spark, {"hub_a": clean.selectExpr("a_hk", "CAST(t AS TIMESTAMP) AS load_dts", "s AS record_source")})
    report = run(clean, tmp_path, "2024-01-02 11:00:00")
    assert report.failures().count() == 0
    for name in TABLES:
        now = rows(spark, tmp_path, name)
        assert now.where("database = 'a' AND run_date = '2024-01-02' AND run_ts < '2024-01-02 11:00:00'").count() == 0, name
        assert sorted(map(repr, now.where("run_date < '2024-01-02' OR database = 'b'").collect())) == sorted(map(repr, other_days[name]))
    assert rows(spark, tmp_path, "failures").where("database = 'a' AND run_date = '2024-01-02'").count() == 0


def test_a_run_of_some_checks_replaces_those_only(spark, tmp_path):
    whole = run(vault_of(spark, ["k", "k"], ["k", "x", None]), tmp_path)
    before = statuses(spark, tmp_path)
    assert before["HUB_A", "H2"][0] == before["SAT_A", "S3"][0] == "FAIL" and before["HUB_A", "H1"][0] == "PASS"
    # Meanwhile the hub has a NULL key and no duplicates, and the satellite is clean.
    later = vault_of(spark, ["k", None], ["k"])
    run(later, tmp_path, "2024-01-02 12:00:00", checks=["H2"])
    found = statuses(spark, tmp_path)
    assert found.pop(("HUB_A", "H2")) == ("PASS", "2024-01-02 12:00:00")
    assert found == {k: v for k, v in before.items() if k != ("HUB_A", "H2")}
    run(later, tmp_path, "2024-01-02 13:00:00", tables=["sat_a"])
    found = statuses(spark, tmp_path)
    assert {moment for (table, _), (_, moment) in found.items() if table == "SAT_A"} == {"2024-01-02 13:00:00"}
    assert found["SAT_A", "S3"][0] == "PASS" and found["HUB_A", "H1"] == before["HUB_A", "H1"] and len(found) == len(before)
    # The summaries are those of all results together.
    results = rows(spark, tmp_path, "check_results")
    assert sorted(r.seq for r in results.collect()) == sorted(r.seq for r in whole.results.collect())
    failing = {(r.table_name, r.check_name) for r in results.where("status IN ('FAIL', 'ERROR')").collect()}
    assert {(r.table_name, r.check_name) for r in rows(spark, tmp_path, "failures").collect()} == failing
    per_table = {r.table_name: r["pass"] + r.fail + r.error + r["info"] for r in rows(spark, tmp_path, "table_summary").collect()}
    assert per_table == {r.table_name: r["count"] for r in results.groupBy("table_name").count().collect()}
    assert sum(r.checks for r in rows(spark, tmp_path, "category_summary").collect()) == len(before)
    # The whole run of the day replaces all of it.
    run(later, tmp_path, "2024-01-02 14:00:00")
    assert {moment for _, moment in statuses(spark, tmp_path).values()} == {"2024-01-02 14:00:00"}


def test_checks_that_a_table_no_longer_has_go_with_its_run(spark, tmp_path):
    run(vault_of(spark, ["k"], ["k"]), tmp_path)
    assert ("SAT_A", "T1") in statuses(spark, tmp_path)
    bare = Vault.from_frames(spark, {"hub_a": spark.createDataFrame([("k", None, "s")], HUB), "sat_a": spark.createDataFrame([("k",)], "a_hk string")})
    run(bare, tmp_path, "2024-01-02 12:00:00", tables=["SAT_A"])
    found = statuses(spark, tmp_path)
    assert {c for t, c in found if t == "SAT_A"} == {"S1", "S3", "T4"} and ("HUB_A", "T1") in found
    numbers = [r.seq for r in rows(spark, tmp_path, "check_results").orderBy("seq").collect()]
    assert numbers == list(range(1, len(found) + 1))


def test_a_first_run_of_some_checks(spark, tmp_path):
    run(vault_of(spark, ["k", "k"]), tmp_path, checks=["H2"])
    assert {k: v[0] for k, v in statuses(spark, tmp_path).items()} == {("HUB_A", "H2"): "FAIL"}


@pytest.mark.parametrize("file_format", ["json", "orc"])
def test_other_formats(spark, tmp_path, file_format):
    run(vault_of(spark, [None, "k"]), tmp_path, file_format=file_format)
    run(vault_of(spark, ["k", "k"]), tmp_path, "2024-01-02 12:00:00", file_format=file_format, checks=["H1"])
    found = {r.check_id: r.status for r in rows(spark, tmp_path, "check_results", file_format).collect()}
    assert found["H1"] == "PASS" and found["H2"] == "PASS" and len(found) == 14


def test_a_writer_lost_before_its_manifest_has_changed_nothing(spark, tmp_path, monkeypatch):
    run(vault_of(spark, [None]), tmp_path)
    before = {name: sorted(map(repr, rows(spark, tmp_path, name).collect())) for name in TABLES}
    report = validate(vault_of(spark, ["k"]), Settings(database="a", as_of="2024-01-02 12:00:00"))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setitem(sink.TABLES, "diagnostics", lost)
        with pytest.raises(KeyboardInterrupt):
            write_tables(report, str(tmp_path))
    assert {name: sorted(map(repr, rows(spark, tmp_path, name).collect())) for name in TABLES} == before
    assert finish_writes(spark, str(tmp_path)) == 0
    assert {name: sorted(map(repr, rows(spark, tmp_path, name).collect())) for name in TABLES} == before
    assert not list((tmp_path / "_staged").iterdir())


@pytest.mark.parametrize("finished_by", ["itself", "the next write"])
def test_a_writer_lost_between_tables_is_finished_later(spark, tmp_path, monkeypatch, finished_by):
    run(vault_of(spark, [None]), tmp_path)
    report = validate(vault_of(spark, ["k"]), Settings(database="a", as_of="2024-01-02 12:00:00"))
    removed = []

    def lost(spark, path):
        removed.append(path)
        raise KeyboardInterrupt

    # Lost when all tables but the last have been replaced, and then once more before the staging area is cleared.
    finish = sink.finish_writes
    with monkeypatch.context() as m:
        calls = []

        def twice(spark, folder):
            calls.append(folder)
            if len(calls) == 2:
                raise KeyboardInterrupt
            return finish(spark, folder)

        m.setattr(sink, "finish_writes", twice)
        with pytest.raises(KeyboardInterrupt):
            write_tables(report, str(tmp_path))
        m.setattr(sink, "remove", lost)
        with pytest.raises(KeyboardInterrupt):
            finish(spark, str(tmp_path))
    assert removed
    if finished_by == "itself":
        assert finish_writes(spark, str(tmp_path)) == 1
    else:
        run(vault_of(spark, ["k"]), tmp_path, database="b")
    for name in TABLES:
        assert {str(r.run_ts) for r in rows(spark, tmp_path, name).where("database = 'a'").collect()} <= {"2024-01-02 12:00:00"}
    assert {r.check_id for r in rows(spark, tmp_path, "check_results").where("database = 'a' AND status = 'PASS'").collect()} >= {"H1"}
    assert finish_writes(spark, str(tmp_path)) == 0


def test_odd_database_names(spark, tmp_path):
    for name in ("Main-Vault 1", "a/b:c%=[x]", "é 中", "it's"):
        run(vault_of(spark, [None]), tmp_path, database=name)
        run(vault_of(spark, ["k"]), tmp_path, "2024-01-02 11:00:00", database=name, checks=["H1"])
    found = {r.database: r["count"] for r in rows(spark, tmp_path, "check_results").groupBy("database").count().collect()}
    assert found == {n: 14 for n in ("Main-Vault 1", "a/b:c%=[x]", "é 中", "it's")}
    # The names are those that Spark itself gives to partitions.
    spark.createDataFrame([("a/b:c%=[x]", 1)], "p string, n int").write.partitionBy("p").parquet(str(tmp_path / "own"))
    assert (tmp_path / "own" / f"p={partition_name('a/b:c%=[x]')}").exists()
    with pytest.raises(ValueError):
        partition_name("")
