import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from granary import schemas as S
from granary import staging
from granary.operators import history, merging
from granary.operators.checks import DuplicateKeyError
from granary.operators.lookups import lookup_as_of
from granary.staging import empty_table

T1, T2, T3 = "2024-01-01", "2024-02-01", "2024-03-01"


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "product_name string, productgroup_name string")


def dim(spark, *rows, at=T1):
    stamp = dt.datetime.fromisoformat(at)
    return spark.createDataFrame([(*r, stamp, stamp) for r in rows], S.DIM_PRODUCT)


def products(df):
    return sorted(
        (r["product_id"], r["product_name"], r["productgroup_name"], r["updated_at"].month)
        for r in df.collect()
    )


def test_pairs_are_distinct_and_named(spark):
    rows = [("a", "g"), ("a", "g"), ("a", None), (None, "g")]
    got = merging.product_pairs(pairs(spark, *rows)).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "g"), ("a", None)]
    one = merging.one_group_per_product(pairs(spark, ("a", "z"), ("a", "b"), ("a", None), ("n", None)))
    assert sorted(map(tuple, one.collect())) == [("a", "b"), ("n", None)]


def test_first_load_has_one_row_per_pair(spark):
    src = pairs(spark, ("b", "y"), ("a", "y"), ("a", "x"))
    got = merging.merge_product_dim(src, empty_table(spark, S.DIM_PRODUCT), T1)
    assert got.schema == S.DIM_PRODUCT
    assert products(got) == [(1, "a", "x", 1), (2, "a", "y", 1), (3, "b", "y", 1)]


def test_merge_keeps_updates_and_inserts(spark):
    target = dim(spark, (1, "g", "same"), (2, "g", "moved"), (3, "g", "gone"), (4, None, "found"), (5, "g", "lost"))
    src = pairs(spark, ("same", "g"), ("moved", "h"), ("found", "g"), ("lost", None), ("new", "g"))
    assert products(merging.merge_product_dim(src, target, T2)) == [
        (1, "same", "g", 1), (2, "moved", "h", 2), (3, "gone", "g", 1),
        (4, "found", "g", 2), (5, "lost", None, 2), (6, "new", "g", 2),
    ]


def test_merge_rerun_changes_nothing(spark):
    src = pairs(spark, ("a", "x"), ("b", None))
    first = merging.merge_product_dim(src, empty_table(spark, S.DIM_PRODUCT), T1)
    assert products(merging.merge_product_dim(src, first, T2)) == products(first)


def test_a_product_of_several_pairs_gets_a_row_for_each(spark):
    src = pairs(spark, ("a", "x"), ("a", "y"))
    got = merging.merge_product_dim(src, dim(spark, (1, "x", "a")), T2)
    assert products(got) == [(1, "a", "x", 1), (2, "a", "y", 2)]


def test_a_single_later_pair_leaves_the_other_rows_of_its_product(spark):
    target = dim(spark, (1, "x", "a"), (2, "y", "a"), (3, None, "a"))
    same = merging.merge_product_dim(pairs(spark, ("a", "x")), target, T2)
    assert products(same) == products(target)
    more = merging.merge_product_dim(pairs(spark, ("a", "z"), ("a", None)), target, T2)
    assert products(more)[3:] == [(4, "a", "z", 2)] and products(more)[:3] == products(target)


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id long, product_name string, productgroup_name string")


def versions(df):
    month = lambda t: t and t.month
    return sorted(
        (r["product_sk"], r["product_id"], r["productgroup_name"], r["is_current"],
         month(r["effective_start_date"]), month(r["effective_end_date"]))
        for r in df.collect()
    )


def apply(spark, *loads, **options):
    hist = empty_table(spark, S.DIM_PRODUCT_SCD2)
    for rows, as_of in loads:
        hist = history.scd2_apply(source(spark, *rows), hist, as_of=as_of, **options)
    return hist


def test_history_versions_a_changed_group(spark):
    hist = apply(spark, ([(1, "a", "x"), (2, "b", "x")], T1), ([(1, "a", "y"), (2, "b", "x"), (3, "c", "x")], T2))
    assert hist.schema == S.DIM_PRODUCT_SCD2
    assert versions(hist) == [
        (1, 1, "x", False, 1, 2), (2, 2, "x", True, 1, None),
        (3, 1, "y", True, 2, None), (4, 3, "x", True, 2, None),
    ]


def test_history_compares_null_safe(spark):
    changes = [(1, "a", None)], [(1, "a", None)], [(1, "a", "")], [(1, "a", "x")]
    hist = apply(spark, *((rows, f"2024-0{i + 1}-01") for i, rows in enumerate(changes)))
    assert versions(hist) == [
        (1, 1, None, False, 1, 3), (2, 1, "", False, 3, 4), (3, 1, "x", True, 4, None),
    ]


def test_history_back_to_an_old_value_is_a_new_version(spark):
    hist = apply(spark, ([(1, "a", "x")], T1), ([(1, "a", "y")], T2), ([(1, "a", "x")], T3))
    assert [v[2:4] for v in versions(hist)] == [("x", False), ("y", False), ("x", True)]
    assert hist.where("is_current").count() == 1


def test_history_keeps_products_missing_from_the_source(spark):
    hist = apply(spark, ([(1, "a", "x"), (2, "b", "x")], T1), ([(2, "b", "x")], T2))
    assert hist.where("is_current").count() == 2


def test_tracked_columns_are_a_choice(spark):
    loads = ([(1, "a", "x")], T1), ([(1, "renamed", "x")], T2)
    assert apply(spark, *loads).count() == 1
    assert apply(spark, *loads, tracked=("productgroup_name", "product_name")).count() == 2


def test_history_source_needs_unique_keys(spark):
    with pytest.raises(DuplicateKeyError):
        apply(spark, ([(1, "a", "x"), (1, "a", "y")], T1))
    rows = spark.createDataFrame(
        [(1, "x", "a", None, None), (2, "x", None, None, None)], S.DIM_PRODUCT
    )
    assert history.product_source(rows).count() == 1


def test_many_loads_at_once_equal_one_by_one(spark):
    rng = random.Random(4)
    loads = []
    for month in range(1, 8):
        keys = rng.sample(range(1, 13), 9)
        loads.append(([(k, f"p{k}", rng.choice(["x", "y", None, ""])) for k in keys], f"2024-0{month}-01"))
    one_by_one = apply(spark, *loads)
    first = apply(spark, *loads[:2])
    at_once = source(spark, *[r for rows, _ in loads[2:] for r in rows]).limit(0).withColumn("loaded", F.lit(T1).cast("timestamp"))
    for rows, as_of in loads[2:]:
        at_once = at_once.unionByName(source(spark, *rows).withColumn("loaded", F.lit(as_of).cast("timestamp")))
    got = history.scd2_apply_loads(at_once, first, "loaded")
    assert versions(got) == versions(one_by_one)
    # Loads that are in the history already change nothing.
    assert versions(history.scd2_apply_loads(at_once, staging.stage(got), "loaded")) == versions(one_by_one)


def test_merges_of_many_loads_equal_one_by_one(spark):
    loads = [
        [("a", "x"), ("b", "x"), ("b", "y")], [("a", "y"), ("c", "x")], [("a", "x"), ("b", "z"), ("d", None)], [("d", "x"), ("a", "x")], [("a", None)],
    ]
    dim = empty_table(spark, S.DIM_PRODUCT)
    for n, rows in enumerate(loads):
        dim = staging.stage(merging.merge_product_dim(pairs(spark, *rows), dim, f"2024-0{n + 1}-01"))
    every = spark.createDataFrame([(p, g, n) for n, rows in enumerate(loads) for p, g in rows], "product_name string, productgroup_name string, load long")
    nothing = empty_table(spark, S.DIM_PRODUCT)
    changes = merging.product_changes_by_load(every, nothing, "load")
    got = merging.apply_product_changes(nothing, changes, T1, "load")
    assert [p[:3] for p in products(got)] == [p[:3] for p in products(dim)]
    again = merging.product_changes_by_load(every.where("load = 4"), got, "load")
    assert again.collect() == []


def test_lookup_as_of_finds_the_version_of_its_time(spark):
    held = spark.createDataFrame(
        [("a", "x", 1, 10), ("a", "x", 7, 30), ("a", "y", 1, 20), ("n", None, 4, 10), ("t", "x", 5, 10), ("t", "x", 6, 10)],
        "name string, grp string, id long, s long",
    ).withColumn("start", F.timestamp_seconds("s"))
    rows = [("a", "x", 5), ("a", "x", 10), ("a", "x", 29), ("a", "x", 30), ("a", "x", None), ("a", "y", 1), ("n", None, 99), ("t", "x", 11), ("a", "z", 11), (None, "x", 11)]
    facts = spark.createDataFrame(rows, "name string, grp string, s long").withColumn("at", F.timestamp_seconds("s"))
    got = lookup_as_of(facts, held, ["name", "grp"], ["id"], "at", "start", ("grp",)).select("name", "grp", "s", "id").collect()
    assert sorted(map(str, got)) == sorted(str(Row(name=n, grp=g, s=s, id=i)) for (n, g, s), i in zip(rows, [1, 1, 1, 7, 7, 1, 4, 6, None, None]))
