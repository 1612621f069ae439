"""Every query against its SQL on the smallest test data."""

import pytest

import __spark_entry__ as entry_points
from conftest import final_plan
from compare import connect, differences
from workload import oracles
from workload import queries as workload_queries

QUERIES = workload_queries.queries()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    con = connect(sf)
    con.sql("SET TimeZone = 'UTC'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert differences(con, SQL[name], df.toArrow()) == ""
    plan = final_plan(df)
    for slow in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert slow not in plan


def test_comparison_notices_differences(spark, con):
    got = spark.range(3).selectExpr("id AS x").toArrow()
    assert differences(con, "SELECT unnest([0, 1, 2])::BIGINT AS x", got) == ""
    assert "rows" in differences(con, "SELECT unnest([0, 1, 1])::BIGINT AS x", got)
    assert "rows" in differences(con, "SELECT unnest([0, 1, 2, 2])::BIGINT AS x", got)
    assert "types" in differences(con, "SELECT unnest([0, 1, 2])::INTEGER AS x", got)
    assert "columns" in differences(con, "SELECT unnest([0, 1, 2])::BIGINT AS y", got)


def test_entry_has_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 6000


def test_late_files_are_delivered_in_one_write(spark, sf, monkeypatch):
    calls, write = [], workload_queries._write_files
    monkeypatch.setattr(workload_queries, "_write_files", lambda *given: calls.append(given) or write(*given))
    landed = workload_queries.late_files(spark, sf).collect()
    assert len(calls) == 1
    assert sum(r["rows"] for r in landed) == workload_queries.base.pricing(spark, sf).count()
