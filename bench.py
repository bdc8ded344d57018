"""Timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`full_run` is the whole validation of the fixture vault (128 checks with all results). Next to it, the same checks are
run as single queries, one after another, which is what the fused passes replace; `one_by_one` gives that time and is
not part of the value. Both give the same values, or the bench fails.

With BENCH_SCALE_ROWS=n it times plans against each other instead, on a hub of n / 3 rows, a link of n / 2 and a satellite of n,
one key with a third of the rows of the latter two, written below $BENCH_SCALE_DIR.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from vaultgauge import Vault, validate
from vaultgauge.testbed import suite, vaults

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SCALE_ROWS = int(os.environ.get("BENCH_SCALE_ROWS", "0"))
HEADLINE = [
    "catalog_parents", "check_specs", "row_count", "hub_dup_hk", "link_dup_combo", "link_orphan", "sat_orphan",
    "sat_orphan_shared", "sat_dup_hk_load", "sat_dup_hk_hashdiff", "load_spike", "single_source", "check_errors",
    "table_summary", "summary_json",
]


def timed(action) -> tuple[float, list]:
    start = time.perf_counter()
    rows = action()
    return round(time.perf_counter() - start, 3), rows


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")  # a run has more generated classes than the default 100
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if SCALE_ROWS:
        folder = os.environ["BENCH_SCALE_DIR"]
        spark.sparkContext.setCheckpointDir(f"{folder}/checkpoints")
        print(json.dumps({"rows": SCALE_ROWS, "seconds": scale(spark, SCALE_ROWS, folder)}, indent=1))
        return
    queries = suite.queries()

    def run():
        return suite.report(spark, SF_DIR).results.collect()

    for _ in range(2):
        timed(run)  # warm up the JVM
    seconds = {}
    full = []
    for _ in range(5):
        took, results = timed(run)
        full.append(took)
    seconds["full_run"] = sorted(full)[2]
    for name in HEADLINE:
        seconds[name], _ = timed(lambda: queries[name](spark, SF_DIR).collect())

    frames = vaults.frames(spark, SF_DIR, vaults.MAIN_VIEWS)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    single = {r.seq: r for r in validate(Vault.from_frames(spark, frames), vaults.settings()).results.collect()}
    one_by_one, values = timed(lambda: {seq: spark.sql(r.query_text).collect()[0][0] or 0 for seq, r in single.items()})
    assert values == {r.seq: r.value for r in results}

    print(
        json.dumps(
            {
                "metric": "validation of the fixture vault, all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "one_by_one": one_by_one,
                "speedup_of_full_run": round(one_by_one / seconds["full_run"], 2),
            }
        )
    )


def scale(spark: SparkSession, rows: int, folder: str) -> dict[str, float]:
    """Seconds of plans that give the same values, the better of two runs each."""
    key = "md5(string(IF(id % 3 = 0, 7, id % {0})))"
    moment = "TIMESTAMP '2024-01-30 12:00:00' - make_dt_interval(int(id % 400), 0, int(id % 60))"
    tables = {
        "hub_a": (rows // 3, ["md5(string(id)) AS a_hk", "'s' AS record_source"]),
        "link_a_b": (
            rows // 2, ["md5(concat('l', id)) AS a_b_hk", f"{key.format(rows // 3)} AS a_hk", "md5(string(id % 1000)) AS b_hk", "'s' AS record_source"]
        ),
        "sat_a": (rows, [f"{key.format(rows // 3)} AS a_hk", "md5(concat('d', id)) AS hash_diff", "concat('s', id % 5) AS record_source"]),
    }
    for name, (n, columns) in tables.items():
        spark.range(n).selectExpr(*columns, f"{moment} AS load_dts").write.mode("overwrite").parquet(f"{folder}/{name}")

    def run(checks, **changes):
        vault = Vault.from_paths(spark, {name: f"{folder}/{name}" for name in tables})
        used = vaults.settings(broadcast_key_bytes=changes.pop("broadcast_key_bytes", 64 << 20), **changes)
        return lambda: sorted((r.table_name, r.check_name, r.value) for r in validate(vault, used, checks=checks).results.collect())

    plans = {
        "satellite duplicates: one scan": run(["S2", "S5"]),
        "satellite duplicates: two jobs": run(["S2", "S5"], share_grains=False),
        "satellite duplicates: hashes first": run(["S2", "S5"], hash_first=True),
        "orphans and hub duplicates: one grouping": run(["H2", "L3", "S3"], broadcast_key_bytes=0),
        "own checks: all rows": run(OWN),
        "own checks: partial results, first run": run(OWN, partials_folder=f"{folder}/kept"),
        "own checks: partial results, unchanged": run(OWN, partials_folder=f"{folder}/kept"),
    }
    seconds, values = {}, {}
    for name, plan in plans.items():
        once = "first run" in name
        runs = [timed(plan) for _ in range(1 if once else 2)]
        seconds[name] = min(took for took, _ in runs)
        values.setdefault(name.split(":")[0], runs[0][1])
        assert all(found == values[name.split(":")[0]] for _, found in runs), name
    return seconds


OWN = ["H1", "L1", "L2", "S1", "S4", "T1", "T2", "T3", "T4", "F1", "F2", "F3", "V1", "V2", "V3", "R1", "R2"]


if __name__ == "__main__":
    main()
