"""Every registered query of the engine against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA, plan_of
from vaultgauge.testbed import oracle, suite

SF = f"{TESTDATA}/sf0.001"
QUERIES = suite.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def one_run_per_vault():
    """The summaries share their run."""
    kept = {}
    run = suite.report

    def once(spark, sf_dir, vault="main", **changes):
        key = (sf_dir, vault, *sorted(changes.items()))
        if key not in kept:
            kept[key] = run(spark, sf_dir, vault, **changes)
        return kept[key]

    suite.report = once
    yield
    suite.report = run


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_point_adds_operators_only_where_they_are_installed():
    more = set(entry.queries()) - set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert bool(more) == (entry.llm is not None)
    assert all(name == "pipeline" or name.startswith("op") for name in more)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    relation = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    plan = plan_of(df)
    assert not any(node in plan for node in ("CartesianProduct", "NestedLoop", "Python", "Pandas"))
    assert columns == sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, expected))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["table_name", "rows", "pass", "fail", "error", "info", "has_fail"]
    assert df.count() == 8
