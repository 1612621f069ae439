import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from granary import schemas as S
from granary.operators.checks import DuplicateKeyError, repeated_keys, require_unique
from granary.operators.dimensions import date_dim, date_spine, load_dim, new_dim_rows
from granary.operators.ids import dense_ids, highest_id
from granary import staging
from granary.staging import empty_table


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names=st.sets(st.text(alphabet="abz éÄ0", max_size=5), min_size=1, max_size=60))
def test_ranges_number_like_one_window(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = dense_ids(df, ["name"], "id", start=5).collect()
    expected = sorted(names, key=lambda n: n.encode())
    assert [r["name"] for r in sorted(got, key=lambda r: r["id"])] == expected
    assert sorted(r["id"] for r in got) == list(range(6, 6 + len(names)))


def test_ids_over_many_ranges(spark):
    df = spark.range(0, 20_000, 1, 16).selectExpr("(id * 7919) % 20000 AS k", "id AS v")
    got = dense_ids(df, ["k"], "id")
    assert got.where("id != k + 1").count() == 0
    assert got.count() == 20_000
    assert got.columns == ["id", "k", "v"]


def test_ids_of_an_empty_frame(spark):
    got = dense_ids(spark.createDataFrame([], "k int"), ["k"], "id")
    assert got.count() == 0


def test_ids_by_two_keys_with_null(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", None)], "p string, g string")
    got = dense_ids(df, ["p", "g"], "id").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", None), (2, "a", "y"), (3, "b", "x")]


def test_highest_id(spark):
    assert highest_id(empty_table(spark, S.DIM_STATE), "state_id") == 0
    assert highest_id(spark.range(4), "id") == 3


def states(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "state_name string")


def test_dimension_grows_and_a_rerun_adds_nothing(spark):
    load = lambda src, dim: load_dim(src, dim, "state_name", "state_id", "state_name")
    first = load(states(spark, "c", "a", None, "a"), empty_table(spark, S.DIM_STATE))
    second = load(states(spark, "b", "a"), first)
    third = load(states(spark, "b", "a", "c"), second)
    assert first.schema == S.DIM_STATE
    rows = sorted((r["state_id"], r["state_name"]) for r in third.collect())
    assert rows == [(1, "a"), (2, "c"), (3, "b")]


def test_source_and_dimension_column_may_differ(spark):
    src = spark.createDataFrame([("x",)], "origin string")
    rows = new_dim_rows(src, empty_table(spark, S.DIM_VARIETY), "origin", "variety_id", "variety", "2024-01-01")
    assert rows.first()["variety"] == "x"
    assert rows.first()["created_at"] == dt.datetime(2024, 1, 1)


def test_date_dimension(spark):
    rows = date_dim(spark, "2023-01-01", "2023-12-31").orderBy("date_id").collect()
    assert len(rows) == 365
    assert tuple(rows[0]) == (1, "01/01/2023")
    assert tuple(rows[31]) == (32, "01/02/2023")
    assert tuple(rows[-1]) == (365, "31/12/2023")
    leap = spark.sql("SELECT DATE'2024-02-28' AS start_date, DATE'2024-03-01' AS end_date")
    assert [r["date_id"] for r in date_spine(leap).collect()] == [1, 2, 3]


def test_unique_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, v string")
    assert [tuple(r) for r in repeated_keys(df, ["k"]).collect()] == [(1, 2)]
    assert require_unique(df, ["k", "v"], "pairs") is df
    with pytest.raises(DuplicateKeyError, match="keys"):
        require_unique(df, ["k"], "keys")


def test_discarded_tables_leave_no_files(spark, tmp_path):
    import os

    kept, gone = (staging.stage(spark.range(3), label) for label in ("kept", "gone"))
    copied = staging.stage(gone, "copied")
    staging.discard(gone)
    assert not os.path.exists(gone._staged_at.removeprefix("file:"))
    assert kept.count() == copied.count() == 3
