"""Partial results per file: equal values, and only new or changed files are read."""

import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tests.test_run import outcomes
from vaultgauge import Settings, Vault, validate
from vaultgauge.operators.partials import profile_of_partials
from vaultgauge.operators.profile import profile, profile_slots
from vaultgauge.plans import incremental
from vaultgauge.plans.passes import make_plan
from vaultgauge.testbed import vaults

# Checks of a table's own rows; those of keys read the data anew.
OWN = ["H1", "S1", "S4", "T1", "T2", "T3", "T4", "F1", "F2", "F3", "V1", "V2", "V3", "R1", "R2"]
ROWS = """SELECT IF(id % 11 = 0, NULL, md5(string(id))) AS a_hk, TIMESTAMP '2024-01-30 12:00:00' - make_dt_interval(int(id % 12), int(id % 5)) AS load_dts,
    IF(id % 7 = 0, NULL, concat('s', id % 3)) AS record_source, IF(id % 13 = 0, NULL, md5(string(id))) AS hash_diff FROM range({0}, {1})"""
AHEAD = "SELECT 'x' AS a_hk, TIMESTAMP '2024-01-30 12:00:00' + make_dt_interval(0, int(id)) AS load_dts, 's0' AS record_source, 'd' AS hash_diff FROM range(-3, 15)"


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def add(spark, folder, sql, name="sat_a"):
    before = set(Path(folder, name).glob("*.parquet"))
    spark.sql(sql).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    (added,) = set(Path(folder, name).glob("*.parquet")) - before
    return added


SCHEMAS = {}


def opened(spark, folder, names):
    """A vault of plain scans. Its schema is read from the files once, as that of a catalog's table is."""
    for name in names:
        if (folder, name) not in SCHEMAS:
            SCHEMAS[folder, name] = spark.read.parquet(f"{folder}/{name}").schema
    return Vault.from_frames(spark, {name: spark.read.schema(SCHEMAS[folder, name]).parquet(f"{folder}/{name}") for name in names})


def run(spark, folder, settings, keep=True, names=("sat_a",), **changes):
    vault = opened(spark, folder, names)
    changes |= {"partials_folder": str(folder / "kept") if keep else None}
    return outcomes(validate(vault, replace(settings, **changes), checks=OWN))


def spoil(file):
    """The same name, size and time, but nothing that could be read."""
    status = os.stat(file)
    Path(file).write_bytes(b"x" * status.st_size)
    Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)
    os.utime(file, ns=(status.st_atime_ns, status.st_mtime_ns))


def test_an_unchanged_table_is_not_read_again(spark, folder, settings):
    files = [add(spark, folder, ROWS.format(a, a + 40)) for a in (0, 40, 80)]
    plain = run(spark, folder, settings, keep=False)
    assert run(spark, folder, settings) == plain
    for file in files:
        spoil(file)
    assert run(spark, folder, settings) == plain
    assert {s for s, _ in run(spark, folder, settings, keep=False).values()} == {"ERROR"}


def test_other_clocks_and_thresholds_need_no_data(spark, folder, settings):
    files = [add(spark, folder, ROWS.format(a, a + 60)) for a in (0, 60)]
    run(spark, folder, settings)
    changes = [
        {"as_of": "2024-01-27 23:30:00"}, {"as_of": "2024-02-03 00:00:00"}, {"stale_hours": 1}, {"spike_multiplier": 1, "spike_window_days": 3},
        {"single_source_percent": 30}, {"as_of": "2024-01-30 00:00:00"},
    ]
    plain = [run(spark, folder, settings, keep=False, **c) for c in changes]
    assert len({repr(sorted(p.items())) for p in plain}) > 3
    # Where the clock lies between the rows of a day, files of that day are read again.
    between = [c.get("as_of", "")[11:] in ("23:30:00", "00:00:00") and c["as_of"] < "2024-02" for c in changes]
    assert [run(spark, folder, settings, **c) for c in changes] == plain
    for file in files:
        spoil(file)
    assert [run(spark, folder, settings, **c) for c, b in zip(changes, between, strict=True) if not b] == [p for p, b in zip(plain, between, strict=True) if not b]


def test_a_new_file_alone_is_read(spark, folder, settings):
    old = [add(spark, folder, ROWS.format(a, a + 40)) for a in (0, 40)]
    run(spark, folder, settings)
    add(spark, folder, ROWS.format(500, 577))
    plain = run(spark, folder, settings, keep=False)
    for file in old:
        spoil(file)
    assert run(spark, folder, settings) == plain
    assert plain["SAT_A", "Total row count"] == ("INFO", 157)


def test_gone_and_rewritten_files(spark, folder, settings):
    first, second = (add(spark, folder, ROWS.format(a, a + 40)) for a in (0, 40))
    run(spark, folder, settings)
    first.unlink()
    assert run(spark, folder, settings) == run(spark, folder, settings, keep=False)
    other = add(spark, folder, ROWS.format(900, 907))
    os.replace(other, second)  # the same name with other rows
    Path(second.parent, f".{second.name}.crc").unlink()
    assert run(spark, folder, settings) == run(spark, folder, settings, keep=False)
    assert run(spark, folder, settings)["SAT_A", "Total row count"] == ("INFO", 7)


def test_rows_ahead_of_the_clock(spark, folder, settings):
    for sql in (ROWS.format(0, 50), AHEAD, AHEAD.replace("range(-3, 15)", "range(1, 4)"), AHEAD.replace("range(-3, 15)", "range(24, 50)")):
        add(spark, folder, sql)
    plain = run(spark, folder, settings, keep=False)
    assert plain["SAT_A", "Future-dated records"][1] == 14 + 3 + 26
    assert run(spark, folder, settings) == plain == run(spark, folder, settings)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "bigint"])
@pytest.mark.parametrize("lenient", [True, False])
def test_types_of_load_times(spark, folder, settings, kind, lenient):
    sql = f"SELECT a_hk, CAST(load_dts AS {kind}) AS load_dts, record_source, hash_diff FROM ({ROWS.format(0, 60)})" if kind != "bigint" else "SELECT 'k' AS a_hk, 1L AS load_dts"
    add(spark, folder, sql)
    add(spark, folder, sql if kind == "bigint" else sql.replace("CAST(load_dts", "CAST(nullif(load_dts, TIMESTAMP '2024-01-30 12:00:00')"))
    if kind == "string":
        add(spark, folder, "SELECT 'k' AS a_hk, 'no time' AS load_dts, 's' AS record_source, 'd' AS hash_diff")
    for _ in range(2):
        assert run(spark, folder, settings, lenient_timestamps=lenient) == run(spark, folder, settings, keep=False, lenient_timestamps=lenient)


def test_sizes_that_choose_plans_are_kept_too(spark, folder, settings):
    add(spark, folder, ROWS.format(0, 60))
    add(spark, folder, ROWS.format(0, 30), "hub_a")
    used = replace(settings, partials_folder=str(folder / "kept"))
    for _ in range(2):
        found = validate(opened(spark, folder, ["hub_a", "sat_a"]), used).results.collect()
        plain = validate(opened(spark, folder, ["hub_a", "sat_a"]), settings).results.collect()
        assert [(r.seq, r.table_name, r.value, r.status) for r in found] == [(r.seq, r.table_name, r.value, r.status) for r in plain]


def test_partitioned_tables_and_odd_folders(spark, folder, settings):
    rows = spark.sql(ROWS.format(0, 90)).withColumn("p", F.expr("concat('a b%=', pmod(hash(a_hk), 3))"))
    rows.repartition(2).write.partitionBy("p").parquet(f"{folder}/sat_é x")
    plain = run(spark, folder, settings, keep=False, names=["sat_é x"])
    assert plain["SAT_É X", "Total row count"] == ("INFO", 90)
    for _ in range(2):
        assert run(spark, folder, settings, names=["sat_é x"]) == plain
    assert list((folder / "kept").rglob("generation-*"))


def test_a_query_is_not_kept(spark, folder, settings):
    add(spark, folder, ROWS.format(0, 60))
    table = spark.read.parquet(f"{folder}/sat_a")
    assert incremental.is_plain_scan(table) and incremental.is_plain_scan(table.alias("t"))
    for df in (table.where("a_hk > 'a'"), table.select("a_hk"), table.union(table), spark.range(3)):
        assert not incremental.is_plain_scan(df)
    vault = Vault.from_frames(spark, {"sat_a": table.where("a_hk > '8'")})
    used = replace(settings, partials_folder=str(folder / "kept"))
    assert outcomes(validate(vault, used)) == outcomes(validate(vault, settings))
    assert not (folder / "kept").exists()


def test_a_lost_writer_leaves_the_generation_before(spark, folder, settings):
    add(spark, folder, ROWS.format(0, 60))
    run(spark, folder, settings)
    add(spark, folder, ROWS.format(60, 99))
    plain = run(spark, folder, settings, keep=False)
    (generation,) = (folder / "kept").rglob("generation-*0")
    broken = generation.with_name("generation-000000001")
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half of it")
    for _ in range(2):
        assert run(spark, folder, settings) == plain
    for n in range(4):
        add(spark, folder, ROWS.format(100 + n, 101 + n))
        run(spark, folder, settings)
    assert len(list((folder / "kept").rglob("generation-*"))) == 2


def test_an_unusable_folder_costs_no_check(spark, folder, settings):
    add(spark, folder, ROWS.format(0, 60))
    (folder / "kept").write_text("a file")
    assert run(spark, folder, settings) == run(spark, folder, settings, keep=False)


def test_many_new_files_are_scanned_in_parts(spark, folder, settings, monkeypatch):
    monkeypatch.setattr(incremental, "FILES_PER_SCAN", 2)
    add(spark, folder, ROWS.format(0, 10))
    run(spark, folder, settings)
    for n in range(5):
        add(spark, folder, ROWS.format(10 * n, 10 * n + 10))
    assert run(spark, folder, settings) == run(spark, folder, settings, keep=False)


def test_other_time_zones_are_kept_apart(spark, folder, settings):
    add(spark, folder, ROWS.format(0, 90))
    for zone in ("UTC", "Asia/Tokyo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert run(spark, folder, settings) == run(spark, folder, settings, keep=False)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_slot_of_the_fixture_vault(spark, tmp_path):
    settings = vaults.settings(partials_folder=str(tmp_path / "kept")).resolved(spark)
    with vaults.bucketed_main_vault(spark, f"{TESTDATA}/sf0.001") as vault:
        plan = make_plan(vault, settings)
        for target in plan.targets.values():
            slots, df = profile_slots(target) | {"rows"}, vault.table(target.source_name)
            kept = incremental.KeptPartials(vault, settings).of(target)
            assert (kept is not None) == bool(df.inputFiles())
            if kept is None:
                continue  # no row, no file
            found = {tuple(r) for r in profile_of_partials(df, kept, target, slots, settings).collect()}
            assert found == {tuple(r) for r in profile(df, target, slots, settings).collect()}


def test_settings_default_to_reading_all(spark):
    assert Settings().partials_folder is None
