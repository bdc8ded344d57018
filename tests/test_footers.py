"""Row counts, newest and oldest load dates from the footers of Parquet files."""

import struct
from pathlib import Path

import pytest

from tests.conftest import plan_of
from tests.test_run import outcomes
from vaultgauge import Vault, validate
from vaultgauge.plans.passes import make_plan, profile_frame
from vaultgauge.sources.footers import by_footers

ROWS = "SELECT md5(string(id)) AS a_hk, nullif(DATE '2024-01-30' - int(id % {0}), DATE '2024-01-29') AS load_date, 's' AS rec_src FROM range({1})"
CHECKS = ["T4", "F1", "F3"]


@pytest.fixture
def folder(spark, tmp_path):
    for n in (40, 25):
        spark.sql(ROWS.format(n, 10 * n)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/sat_a")
    return tmp_path


def vault_of(spark, folder, schema="a_hk string, load_date date, rec_src string"):
    return Vault.from_frames(spark, {"sat_a": spark.read.schema(schema).parquet(f"{folder}/sat_a")})


def spoil_pages(folder):
    """Zeros in place of all that lies before the footers."""
    for file in Path(folder, "sat_a").glob("*.parquet"):
        content = file.read_bytes()
        footer = struct.unpack("<I", content[-8:-4])[0] + 8
        file.write_bytes(b"PAR1" + bytes(len(content) - footer - 4) + content[-footer:])
        Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)


def test_counts_and_dates_are_pushed_down(spark, folder, settings):
    vault = vault_of(spark, folder)
    target = make_plan(vault, settings).targets["SAT_A"]
    plan = plan_of(profile_frame(vault, target, ["T4", "F1", "F3", "rows"], settings, from_footers=True))
    pushed = plan.upper().split("PUSHEDAGGREGATION")[1].splitlines()[0]
    assert all(f in pushed for f in ("COUNT(*)", "MAX(LOAD_DATE)", "MIN(LOAD_DATE)"))
    for slots in (["T4", "F1", "F3"], ["T4", "T1"]):
        assert "PUSHEDAGGREGATION" not in plan_of(profile_frame(vault, target, slots, settings)).upper()


def test_no_data_page_is_read(spark, folder, settings):
    plain = outcomes(validate(vault_of(spark, folder), settings, checks=[*CHECKS, "T1"]))
    expected = {k: v for k, v in plain.items() if "NULL" not in k[1]}
    assert expected["SAT_A", "Total row count"] == ("INFO", 650) and expected["SAT_A", "Oldest record age (days)"] == ("INFO", 39)
    assert outcomes(validate(vault_of(spark, folder), settings, checks=CHECKS)) == expected
    spoil_pages(folder)
    assert outcomes(validate(vault_of(spark, folder), settings, checks=CHECKS)) == expected
    spoiled = outcomes(validate(vault_of(spark, folder), settings, checks=["F1", "T1"]))
    assert {status for status, _ in spoiled.values()} == {"ERROR"}


def test_timestamps_are_read(spark, tmp_path, settings):
    spark.sql(ROWS.format(9, 90).replace("AS load_date", ":: timestamp AS load_date")).write.parquet(f"{tmp_path}/sat_a")
    found = outcomes(validate(vault_of(spark, tmp_path, "a_hk string, load_date timestamp, rec_src string"), settings, checks=CHECKS))
    assert found["SAT_A", "Oldest record age (days)"] == ("INFO", 8) and found["SAT_A", "Total row count"] == ("INFO", 90)


def test_footers_without_statistics_are_read_by_rows(spark, tmp_path, settings):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "sat_a").mkdir()
    dates = pa.array([dt.date(2024, 1, 1), None, dt.date(2024, 1, 25)], pa.date32())
    pq.write_table(pa.table({"a_hk": ["a", "b", "c"], "load_date": dates, "rec_src": ["s"] * 3}), tmp_path / "sat_a/part.parquet", write_statistics=False)
    found = outcomes(validate(vault_of(spark, tmp_path), settings, checks=CHECKS))
    assert found["SAT_A", "Oldest record age (days)"] == ("INFO", 29) and {s for s, _ in found.values()} == {"INFO", "FAIL"}


def test_partitioned_folders_and_empty_tables(spark, tmp_path, settings):
    spark.sql(ROWS.format(9, 90)).selectExpr("*", "length(a_hk) AS p").write.partitionBy("p").parquet(f"{tmp_path}/sat_a")
    schema = "a_hk string, load_date date, rec_src string, p int"
    found = outcomes(validate(vault_of(spark, tmp_path, schema), settings, checks=CHECKS))
    assert found["SAT_A", "Total row count"] == ("INFO", 90) and found["SAT_A", "Oldest record age (days)"] == ("INFO", 8)
    spark.sql(ROWS.format(9, 0)).write.parquet(f"{tmp_path}/empty/sat_a")
    assert {v for _, v in outcomes(validate(vault_of(spark, tmp_path / "empty"), settings, checks=CHECKS)).values()} == {0}


def test_other_tables_are_left_as_they_are(spark, tmp_path):
    spark.range(3).write.orc(f"{tmp_path}/orc")
    spark.range(3).write.parquet(f"{tmp_path}/parquet")
    parquet = spark.read.parquet(f"{tmp_path}/parquet")
    for df in (spark.read.orc(f"{tmp_path}/orc"), parquet.where("id > 1"), spark.range(3)):
        assert by_footers(df) is None
    assert by_footers(parquet).count() == 3 and by_footers(parquet).columns == ["id"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
