"""What keeps the plans fit for large data: pushdown, pruning, and hot keys."""

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from conftest import final_plan
from granary import schemas as S
from granary.operators import control, nested
from granary.operators.facts import build_fact
from granary.operators.ids import dense_ids
from granary.operators.lookups import full_outer, lookup
from granary.operators.report import price_weather_report
from granary.sinks.tables import append_files
from granary.staging import stage
from workload import base


@contextlib.contextmanager
def settings(spark, **values):
    keys = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def no_broadcast(spark):
    """Joins as beyond the broadcast threshold, partitions of a few KB as hot."""
    return settings(
        spark,
        spark__sql__shuffle__partitions=32,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=16 * 1024,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=32 * 1024,
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    )


def hot_rows(spark, n=60_000):
    """A third of the rows with one key, a third without a key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)
    return stage(spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"), text.alias("t")))


def test_a_hot_key_is_split_in_a_lookup(spark):
    rows = hot_rows(spark)
    dim = stage(spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")))
    with no_broadcast(spark):
        got = lookup(rows, dim, ["k"], ["w"])
        found = got.collect()
        assert "skew=true" in final_plan(got)
    assert len(found) == 60_000
    assert all(r["w"] == (None if r["k"] is None else 2 * r["k"]) for r in found)


def test_a_hot_key_is_split_in_a_full_outer_join(spark):
    rows = hot_rows(spark)
    other = stage(spark.range(0, 90_000, 1, 8).select(F.col("id").alias("j"), (F.col("id") * 2).alias("w")))
    with no_broadcast(spark):
        got = full_outer(rows, other, [("k", "j")])
        found = got.collect()
        assert "skew=true" in final_plan(got)
    native = rows.join(other, rows.k == other.j, "full")
    assert sorted(map(str, found)) == sorted(map(str, native.collect()))


def test_facts_without_broadcast_are_the_same(spark, sf):
    from workload import queries

    with no_broadcast(spark):
        shuffled = queries.fact_daily_pricing(spark, sf).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, queries.fact_daily_pricing(spark, sf).collect()))


def test_report_without_broadcast_is_the_same(spark, sf):
    from workload import queries

    with no_broadcast(spark):
        shuffled = queries.price_weather_report(spark, sf).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, queries.price_weather_report(spark, sf).collect()))


def test_watermark_reaches_the_files(spark, sf):
    events = base.table(spark, sf, "events")
    log = base.run_log(spark, sf)
    plan = final_plan(control.incremental_rows(events, log, "purchase", column="ts"))
    assert "GreaterThan(ts," in plan
    assert "ReadSchema: struct<event_id" in plan


def test_batch_watermark_prunes_partitions(spark, tmp_path):
    rows = spark.range(6).select(
        "id", F.timestamp_micros(F.col("id") * 1_000_000).alias("source_file_load_date")
    ).withColumn("load_batch", control.load_batch())
    path = str(tmp_path / "bronze")
    append_files(rows, path, ("load_batch",))
    at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=3)
    log = control.run_entry(spark, "p", at.date(), "Completed", watermark_ts=at)
    new = control.incremental_rows(spark.read.parquet(path), log, "p", batch_column="load_batch")
    assert sorted(r["id"] for r in new.collect()) == [4, 5]
    partition_filters = final_plan(new).split("PartitionFilters: [")[1].split("]")[0]
    assert "load_batch" in partition_filters


def test_facts_read_only_their_columns_and_join_map_side(spark, sf):
    silver = stage(base.pricing(spark, sf))
    dims = [
        spark.createDataFrame([], schema).limit(0)
        for schema in (S.DIM_DATE, S.DIM_STATE, S.DIM_MARKET, S.DIM_PRODUCT, S.DIM_VARIETY)
    ]
    dims = [stage(dim) for dim in dims]
    fact = build_fact(silver, *dims)
    fact.collect()
    plan = final_plan(fact).split("Initial Plan")[0]
    assert "origin" not in plan
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_ranges_do_not_gather_the_keys_in_one_task(spark):
    keys = spark.range(0, 50_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    numbered = dense_ids(keys, ["k"], "id")
    plan = final_plan(numbered)
    gathered = plan.split("Exchange SinglePartition")
    # Only the row counts of the ranges meet in one partition.
    assert len(gathered) == 2
    assert "HashAggregate" in gathered[1].splitlines()[1]


def test_flattening_is_one_scan_without_shuffle(spark, tmp_path):
    path = str(tmp_path / "geo")
    spark.createDataFrame([([("s", "d", "c", 1.0, 2.0, "m", 3)],)], S.GEOCODE_RESPONSE).write.json(path)
    plan = final_plan(nested.flatten_locations(spark.read.schema(S.GEOCODE_RESPONSE).json(path)))
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_report_shuffles_prices_once_and_spreads_a_hot_market_day(spark):
    day = dt.date(2023, 1, 1)
    hot = F.col("id") % 3 == 0
    ids = spark.range(0, 30_000, 1, 8)
    values = {name: F.lit(None) for name in S.SILVER_PRICING.fieldNames()} | {
        "date_of_pricing": F.when(hot, F.lit(day)).otherwise(F.date_add(F.lit(day), (F.col("id") % 300).cast("int"))),
        "row_id": F.col("id"), "state_name": F.lit("S"), "market_name": F.when(hot, "M").otherwise(F.concat(F.lit("N"), F.col("id") % 50)),
    }
    silver = stage(ids.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in S.SILVER_PRICING]))
    geo = stage(spark.createDataFrame([("S", None, None, 1.0, 2.0, "M", 3)], S.GEO_LOCATION))
    weather = stage(spark.createDataFrame([("M", 0.0, 0.0, "2023-01-01", 30.0, "C", 20.0, 1.0, "mm", 0)], S.WEATHER_DATA))
    with no_broadcast(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            report = price_weather_report(silver, geo, weather)
            found = report.groupBy("market_name", "MARKET_POPULATION", "MARKET_MAX_TEMPARATURE").count().collect()
            laid_out = report.where("row_id is not null").withColumn("task", F.spark_partition_id()).where("market_name = 'M'")
            tasks = laid_out.groupBy("task").count().collect()
            plan = final_plan(price_weather_report(silver, geo, weather))
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in found) == 30_000
    assert {(r[1], r[2]) for r in found if r[0] == "M"} == {(3, 30.0)} and "Broadcast" not in plan
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 5_000
    # One exchange moves the prices, that of their layout; row ids are read by one scan.
    assert plan.count("REPARTITION_BY_COL") == 1 and sum("Scan parquet" in line and "row_id" in line for line in plan.splitlines()) == 1
    prices = next(line for line in plan.splitlines() if "REPARTITION_BY_COL" in line)
    assert "_state_key" in prices and "_part" in prices
