"""One query per operator, over whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import calendar_text, file_date, json_line, price_file
from granary.operators import cleaning, control, dimensions, facts, history, merging, nested, report
from granary.operators import requests as req
from granary.operators.ids import dense_ids, highest_id
from granary.operators.lookups import full_outer, lookup, unmatched_right
from granary.plans import daily
from granary.plans import lakehouse as names
from granary.plans.lakehouse import Lakehouse
from granary.plans.reference_data import copy_reference_table
from granary.sinks import tables
from granary.sinks.tables import append_files, read_evolving
from granary.sources.daily_csv import daily_files, read_daily_files
from granary.sources.fixtures import load_fixture
from granary.sources import json_docs
from granary.sources.json_docs import land_weather, read_json_lines
from granary.staging import drop_shuffles, empty_table, scratch_path, stage
from granary.streaming.daily import load_micro_batch
from granary.streaming.landing import land_available, stream_daily_files
from workload import base

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

FACT_START, FACT_END = "1997-01-01", "1997-12-31"
FIRST_LOAD, SECOND_LOAD, THIRD_LOAD, FOURTH_LOAD = "2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _without_stamps(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


# --- cleaning ---------------------------------------------------------------


@query
def clean_daily_pricing(spark: SparkSession, sf: str) -> DataFrame:
    return _without_stamps(cleaning.clean_daily_pricing(base.raw_pricing(spark, sf)))


@query
def clean_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = cleaning.rejected_values(base.raw_pricing(spark, sf))
    return rejects.select(
        "ROW_ID", "DATE_OF_PRICING", "ARRIVAL_IN_TONNES",
        F.concat_ws(",", "rejected_columns").alias("rejected_columns"),
    )


# --- control ----------------------------------------------------------------


@query
def next_file_date(spark: SparkSession, sf: str) -> DataFrame:
    return control.next_file_date(base.run_log(spark, sf), "purchase")


def _newer_events(spark: SparkSession, sf: str, precision: str) -> DataFrame:
    landed = base.table(spark, sf, "events").select("event_id", "event_type", "ts")
    log = base.run_log(spark, sf, completed_above=150)
    return control.incremental_rows(landed, log, "purchase", precision, column="ts")


@query
def incremental_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _newer_events(spark, sf, "timestamp")


@query
def incremental_rows_date_precision(spark: SparkSession, sf: str) -> DataFrame:
    return _newer_events(spark, sf, "date")


@query
def unstamped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Price rows by what an incremental load makes of them: taken, older than the watermark, or without a load stamp."""
    rows = base.raw_pricing(spark, sf)
    stamp = F.when(F.col("ROW_ID").endswith("7"), None).otherwise(F.col("source_file_load_date"))
    src = stage(rows.withColumn("source_file_load_date", stamp), "bronze")
    log = control.run_entry(spark, S.PROCESS_SILVER, None, S.STATUS_COMPLETED, watermark_ts=dt.datetime(1998, 1, 1))
    taken = control.incremental_rows(src, log, S.PROCESS_SILVER)
    lost = control.unstamped_rows(src)
    sides = [taken.select(F.lit("taken").alias("outcome")), lost.select(F.lit("no stamp").alias("outcome"))]
    return reduce(DataFrame.unionByName, sides).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query
def run_log_latest(spark: SparkSession, sf: str) -> DataFrame:
    log = base.run_log(spark, sf, completed_above=150)
    batch = _newer_events(spark, sf, "timestamp")
    logged = log.unionByName(control.batch_entry(batch, "purchase", base.AS_OF, column="ts"))
    runs = control.completed_runs(logged, "purchase")
    return runs.agg(
        F.max("processed_file_table_date").alias("last_date"),
        F.max("watermark_ts").cast("timestamp_ntz").alias("last_watermark"),
        F.count(F.lit(1)).alias("completed_runs"),
    )


# --- ids and dimensions -----------------------------------------------------


@query
def dense_ids_by_range(spark: SparkSession, sf: str) -> DataFrame:
    keys = base.table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return dense_ids(keys, ["l_orderkey"], "order_id", start=1000)


def _first_dim(spark: SparkSession, silver: DataFrame, schema, src_col: str) -> DataFrame:
    id_col, name_col = schema.fieldNames()[:2]
    return dimensions.load_dim(
        silver, empty_table(spark, schema), src_col, id_col, name_col
    )


@query
def dim_state(spark: SparkSession, sf: str) -> DataFrame:
    prices = base.pricing(spark, sf)
    return _without_stamps(_first_dim(spark, prices, S.DIM_STATE, "state_name"))


@query
def dim_market(spark: SparkSession, sf: str) -> DataFrame:
    prices = base.pricing(spark, sf)
    return _without_stamps(_first_dim(spark, prices, S.DIM_MARKET, "market_name"))


@query
def dim_variety(spark: SparkSession, sf: str) -> DataFrame:
    prices = base.pricing(spark, sf)
    return _without_stamps(_first_dim(spark, prices, S.DIM_VARIETY, "variety"))


@query
def dim_incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    """Origins of one state first, then those of all states."""
    silver = base.silver(spark, sf)
    earlier = silver.where(F.col("state_name") == "ASIA")
    dim = stage(_first_dim(spark, earlier, S.DIM_VARIETY, "origin"))
    return _without_stamps(dimensions.load_dim(silver, dim, "origin", "variety_id", "variety"))


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Every day from the first to the last order."""
    day = F.col("o_orderdate").cast("date")
    bounds = base.table(spark, sf, "orders").agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date")
    )
    return dimensions.date_dim_between(bounds)


@query
def dim_product_first_load(spark: SparkSession, sf: str) -> DataFrame:
    pairs = merging.product_pairs(base.pricing(spark, sf))
    empty = empty_table(spark, S.DIM_PRODUCT)
    return _without_stamps(merging.merge_product_dim(pairs, empty))


@query
def dim_product_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Products of one variety first, then all products, one group each."""
    silver = base.silver(spark, sf)
    earlier = silver.where(F.col("variety") == "Brand#1")
    empty = empty_table(spark, S.DIM_PRODUCT)
    first = merging.one_group_per_product(merging.product_pairs(earlier))
    dim = stage(merging.merge_product_dim(first, empty, FIRST_LOAD))
    pairs = merging.one_group_per_product(merging.product_pairs(silver))
    return merging.merge_product_dim(pairs, dim, SECOND_LOAD).select(
        "product_id", "productgroup_name", "product_name",
        F.col("created_at").cast("date").alias("created_on"),
        F.col("updated_at").cast("date").alias("updated_on"),
    )


# --- type-2 history ---------------------------------------------------------


def _products(spark: SparkSession, sf: str) -> DataFrame:
    pairs = merging.product_pairs(base.pricing(spark, sf))
    empty = empty_table(spark, S.DIM_PRODUCT)
    return history.product_source(stage(merging.merge_product_dim(pairs, empty)))


def _history(spark: SparkSession, *loads: tuple[DataFrame, str]) -> DataFrame:
    hist = empty_table(spark, S.DIM_PRODUCT_SCD2)
    for source, as_of in loads:
        hist = stage(history.scd2_apply(source, hist, as_of=as_of), "history")
    return _history_rows(hist)


def _history_rows(hist: DataFrame) -> DataFrame:
    return hist.select(
        "product_sk", "product_id", "productgroup_name", "product_name", "is_current",
        F.col("effective_start_date").cast("date").alias("start_on"),
        F.col("effective_end_date").cast("date").alias("end_on"),
        F.col("updated_at").cast("date").alias("updated_on"),
    )


@query
def scd2_first_load(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, (_products(spark, sf), FIRST_LOAD))


@query
def scd2_change(spark: SparkSession, sf: str) -> DataFrame:
    """Part of the products first; then all of them, one group renamed."""
    products = _products(spark, sf)
    group = F.col("productgroup_name")
    renamed = F.when(group == "LARGE", "BULK").otherwise(group)
    return _history(
        spark,
        (products.where(F.col("product_name") < "s"), FIRST_LOAD),
        (products.withColumn("productgroup_name", renamed), SECOND_LOAD),
    )


@query
def scd2_null_group(spark: SparkSession, sf: str) -> DataFrame:
    """One group lost in the second load; the third load must not version it again."""
    products = _products(spark, sf)
    lost = F.when(F.col("productgroup_name") != "PROMO", F.col("productgroup_name"))
    later = products.withColumn("productgroup_name", lost)
    return _history(spark, (products, FIRST_LOAD), (later, SECOND_LOAD), (later, THIRD_LOAD))


@query
def scd2_rerun_noop(spark: SparkSession, sf: str) -> DataFrame:
    products = _products(spark, sf)
    return _history(spark, (products, FIRST_LOAD), (products, SECOND_LOAD))


@query
def scd2_many_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads in one pass over a history that has had one: a group renamed, lost, and found again."""
    products = stage(_products(spark, sf), "products")
    group = F.col("productgroup_name")
    hist = stage(history.scd2_apply(products.where(F.col("product_name") < "s"), empty_table(spark, S.DIM_PRODUCT_SCD2), as_of=FIRST_LOAD), "history")
    loads = [
        (products.withColumn("productgroup_name", F.when(group == "LARGE", "BULK").otherwise(group)), SECOND_LOAD),
        (products.withColumn("productgroup_name", F.when(group != "PROMO", group)), THIRD_LOAD),
        (products.where(F.col("product_id") % 3 > 0), FOURTH_LOAD),
    ]
    rows = reduce(DataFrame.unionByName, [p.withColumn("loaded", F.lit(at).cast("timestamp")) for p, at in loads])
    return _history_rows(history.scd2_apply_loads(rows, hist, "loaded", as_of=FOURTH_LOAD)).drop("updated_on")


# --- facts ------------------------------------------------------------------


def _facts(spark: SparkSession, rows: DataFrame, silver: DataFrame) -> DataFrame:
    """Facts of `rows` with dimensions loaded from `silver`."""
    empty = empty_table(spark, S.DIM_PRODUCT)
    fact = facts.build_fact(
        rows,
        dimensions.date_dim(spark, FACT_START, FACT_END),
        _first_dim(spark, silver, S.DIM_STATE, "state_name"),
        _first_dim(spark, silver, S.DIM_MARKET, "market_name"),
        merging.merge_product_dim(merging.product_pairs(silver), empty),
        _first_dim(spark, silver, S.DIM_VARIETY, "variety"),
    )
    return _without_stamps(fact)


@query
def fact_min_slice(spark: SparkSession, sf: str) -> DataFrame:
    silver = base.silver(spark, sf)
    state = _first_dim(spark, silver, S.DIM_STATE, "state_name")
    days = dimensions.date_dim(spark, FACT_START, FACT_END)
    rows = silver.withColumn("calendar_date", calendar_text("date_of_pricing"))
    rows = lookup(rows, state, ["state_name"], ["state_id"])
    rows = lookup(rows, days, ["calendar_date"], ["date_id"])
    return rows.select("row_id", "state_id", "date_id", "modal_price")


@query
def fact_daily_pricing(spark: SparkSession, sf: str) -> DataFrame:
    silver = base.silver(spark, sf)
    return _facts(spark, silver, silver)


@query
def fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of the price rows loaded after the batch that ended with 1999."""
    stamped = base.pricing(spark, sf).withColumn(
        "source_file_load_date", F.col("date_of_pricing").cast("timestamp")
    )
    silver = stage(stamped, "silver")
    loaded = silver.where(F.col("date_of_pricing") < F.lit("2000-01-01").cast("date"))
    log = control.batch_entry(loaded, S.PROCESS_FACT)
    new = control.incremental_rows(silver, log, S.PROCESS_FACT)
    return _facts(spark, new, silver)


# --- nested responses -------------------------------------------------------


@query
def flatten_locations(spark: SparkSession, sf: str) -> DataFrame:
    return nested.flatten_locations(base.geocoding(spark, sf))


@query
def locations_filter_present(spark: SparkSession, sf: str) -> DataFrame:
    """Replies with a result list; one with a negative balance came back without."""
    responses = base.geocoding(spark, sf)
    negative = F.exists("results", lambda r: r["longitude"] < 0)
    some = responses.withColumn("results", F.when(~negative, F.col("results")))
    return nested.with_results(some).select(
        "reply", F.array_size("results").cast("bigint").alias("n_results")
    )


@query
def flatten_weather(spark: SparkSession, sf: str) -> DataFrame:
    return nested.flatten_weather(base.weather(spark, sf)).drop("sequenceId")


@query
def weather_length_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Market years that miss the rainfall of a day when missing values are dropped."""
    responses = base.weather(spark, sf)
    short = F.col("daily").withField("rain_sum", F.array_compact("daily.rain_sum"))
    rows = nested.weather_length_mismatch(responses.withColumn("daily", short))
    return rows.select("marketName", "latitude", F.size("daily.rain_sum").cast("bigint").alias("rain_days"))


@query
def struct_fields(spark: SparkSession, sf: str) -> DataFrame:
    """One field of all results of a reply, as a list; NULLs stay in place."""
    states = F.transform("results.admin1", lambda state: F.coalesce(state, F.lit("?")))
    return base.geocoding(spark, sf).select(
        "reply",
        F.array_join(states, ",").alias("states"),
        F.array_join("results.name", ",").alias("markets"),
    )


@query
def explode_cross_limit(spark: SparkSession, sf: str) -> DataFrame:
    lists = base.geocoding(spark, sf).select(
        "reply",
        F.col("results.name").alias("name"),
        F.col("results.longitude").alias("longitude"),
        F.col("results.latitude").alias("latitude"),
        F.col("results.population").alias("population"),
    )
    return nested.explode_cross(
        lists, ["name", "longitude", "latitude", "population"], 2000, ["reply"]
    )


def _weather_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw response lines of which two years are no JSON objects."""
    line = json_line("latitude", "longitude", "daily", "daily_units")
    year = F.col("latitude") * 4
    text = (
        F.when(year == 1996, F.concat(F.lit("["), line, F.lit("]")))
        .when(year == 1997, F.substring(line, 1, 40))
        .otherwise(line)
    )
    return base.weather(spark, sf).select("marketName", text.alias("value"))


@query
def land_weather_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Weather of the response lines that are JSON objects."""
    return nested.flatten_weather(land_weather(_weather_lines(spark, sf))).drop("sequenceId")


@query
def rejected_responses(spark: SparkSession, sf: str) -> DataFrame:
    """The response lines that `land_weather_lines` leaves out, counted by market and first letter."""
    rejected = json_docs.rejected_responses(_weather_lines(spark, sf), S.WEATHER_RESPONSE, tags=("marketName",))
    first = F.substring("response", 1, 1).alias("first_letter")
    return rejected.groupBy("marketName", first).agg(F.count(F.lit(1)).alias("responses"))


@query
def price_weather_report(spark: SparkSession, sf: str) -> DataFrame:
    silver = base.silver(spark, sf)
    geo = stage(nested.flatten_locations(base.market_locations(spark, sf)), "geo")
    # Prices of one market meet neither a location nor weather.
    geo = geo.where("marketName <> 'NATION_7'")
    days = stage(nested.flatten_weather(base.weather(spark, sf)).where("marketName <> 'NATION_7'"), "weather")
    return report.price_weather_report(silver, geo, days).drop(
        "lakehouse_inserted_date", "lakehouse_updated_date"
    )


# --- landing and copies -----------------------------------------------------


def _price_text(spark: SparkSession, sf: str) -> DataFrame:
    """Price rows as file text, with the month they were delivered in."""
    prices = base.pricing(spark, sf)
    day = F.date_format("date_of_pricing", S.PRICING_DATE_FORMAT).alias("DATE_OF_PRICING")
    rest = [F.col(c.lower()).cast("string").alias(c) for c in S.PRICING_COLUMNS[1:]]
    return prices.select(day, *rest, F.trunc("date_of_pricing", "month").alias("month"))


def _write_files(rows: DataFrame, folder: str, columns: list[str], above: tuple[str, ...] = ()) -> None:
    """One folder per month that is named like a price file, below those of the columns `above`."""
    files = rows.select(*columns, *above, price_file("month").alias("file")).hint("rebalance", "file")
    files.write.partitionBy(*above, "file").option("header", "true").option("compression", "gzip").mode("append").csv(folder)
    drop_shuffles(rows.sparkSession)


def _paths(spark: SparkSession, folder: str) -> list[str]:
    return [row["path"] for row in daily_files(spark, folder).select("path").collect()]


@query
def csv_landing_union(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose header changed in 1998: other column order, one column more."""
    rows = stage(_price_text(spark, sf)).withColumn("GRADE", F.substring("VARIETY", 7, 2))
    folder = scratch_path(spark, "landing")
    columns = list(S.PRICING_COLUMNS)
    _write_files(rows.where("year(month) < 1998"), folder, columns)
    _write_files(rows.where("year(month) >= 1998"), folder, [*reversed(columns), "GRADE"])
    return read_daily_files(spark, _paths(spark, folder), on_drift="align")


# --- the daily load over catalog tables -------------------------------------


def _daily_lake(spark: SparkSession) -> Lakehouse:
    """Fresh catalog tables, in databases of their own, below a scratch folder."""
    lake = Lakehouse(spark, scratch_path(spark, "lake"), f"w{uuid.uuid4().hex}_")
    lake.create()
    return lake


def _deliver(rows: DataFrame, folder: str, above: tuple[str, ...] = ()) -> None:
    """Monthly files whose names are dated thirty years on, after the first file date."""
    _write_files(rows.withColumn("month", F.add_months("month", 360)), folder, list(S.PRICING_COLUMNS), above)


def _with_bad_amounts(rows: DataFrame) -> DataFrame:
    """Every row whose id ends in 3 has a quantity that does not parse."""
    amount = F.col("ARRIVAL_IN_TONNES")
    return rows.withColumn("ARRIVAL_IN_TONNES", F.when(F.col("ROW_ID").endswith("3"), F.concat(amount, F.lit(" t"))).otherwise(amount))


def _two_landings(spark: SparkSession, sf: str, between=lambda lake: None, change=lambda rows: rows) -> Lakehouse:
    """All months but those of 1996 land first, those then: late files. Some amounts do not parse."""
    lake, folder = _daily_lake(spark), scratch_path(spark, "landing")
    rows = change(_with_bad_amounts(_price_text(spark, sf))).withColumn("late", F.year("month") == 1996)
    _deliver(rows, folder, ("late",))
    # The late files lie beside the others and are seen by the second landing only.
    for seen, as_of in ((f"{folder}/late=false", "2024-01-01 01:00:00"), (folder, "2024-01-02 01:00:00")):
        daily.ingest_prices(lake, seen, as_of)
        between(lake)
    return lake


@query
def late_files(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows by file date, after a second landing of files dated before the last of the first."""
    lake = _two_landings(spark, sf)
    landed = lake.table(names.BRONZE)
    return landed.groupBy("file_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def daily_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the silver step has put aside."""
    lake = _two_landings(spark, sf)
    daily.load_silver(lake, "2024-01-03")
    return lake.rejected_prices().select(
        F.col("ROW_ID").cast("bigint").alias("row_id"), "ARRIVAL_IN_TONNES", F.concat_ws(",", "rejected_columns").alias("rejected")
    )


@query
def daily_star_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of two daily loads with the names their keys stand for."""

    def load(lake: Lakehouse) -> None:
        daily.load_silver(lake, "2024-01-03")
        daily.load_date_dim(lake, "1995-01-01", "2010-12-31")
        daily.load_dimensions(lake, "2024-01-03")
        daily.load_facts(lake, "2024-01-03")

    return _named_facts(_two_landings(spark, sf, load))


def _named_facts(lake: Lakehouse) -> DataFrame:
    """Facts with the names their keys stand for."""
    fact = lake.table(names.FACT)
    for name in (names.DIM_DATE, names.DIM_STATE, names.DIM_MARKET, names.DIM_PRODUCT, names.DIM_VARIETY):
        dim = lake.table(name).drop("created_at", "updated_at", names.BUCKET)
        fact = fact.join(dim, dim.columns[0], "left")
    return fact.select(
        "row_id", "calendar_date", "state_name", "market_name", "product_name", "productgroup_name", "variety",
        "arrival_in_tonnes", "minimum_price", "maximum_price", "modal_price",
    )


@query
def stream_daily_load(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of price files loaded as micro-batches, each of which is repeated once."""
    lake, folder = _daily_lake(spark), scratch_path(spark, "landing")
    _deliver(_with_bad_amounts(_price_text(spark, sf)), folder)
    daily.load_date_dim(lake, "1995-01-01", "2010-12-31")

    def twice(rows: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            load_micro_batch(lake, rows, batch_id, "2024-01-03")

    stream = stream_daily_files(spark, folder, 60, "2024-01-02").writeStream.foreachBatch(twice)
    stream.option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    return _named_facts(lake)


@query
def fact_after_skipped_run(spark: SparkSession, sf: str) -> DataFrame:
    """Product ids of facts where the facts of the first load were left out, and all products moved to another group in the second."""

    def one_group(rows: DataFrame) -> DataFrame:
        group = F.col("PRODUCTGROUP_NAME")
        later = F.when(F.year("month") == 1996, F.concat(group, F.lit(" II"))).otherwise(group)
        return rows.withColumns({"PRODUCT_NAME": F.concat_ws("/", "PRODUCT_NAME", group), "PRODUCTGROUP_NAME": later})

    loads = iter(("2024-01-01 02:00:00", "2024-01-02 02:00:00"))

    def dimensions_only(lake: Lakehouse) -> None:
        as_of = next(loads)
        daily.load_silver(lake, as_of)
        daily.load_dimensions(lake, as_of)

    lake = _two_landings(spark, sf, dimensions_only, one_group)
    daily.load_date_dim(lake, "1995-01-01", "2010-12-31")
    daily.load_facts(lake, "2024-01-02 03:00:00")
    product = lake.table(names.DIM_PRODUCT).select("product_id", "product_name", "productgroup_name")
    return lake.table(names.FACT).join(product, "product_id", "left").select("row_id", "product_id", "product_name", "productgroup_name")


@query
def step_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the steps of two daily loads have read, written and rejected, as they saw it while they wrote."""

    def load(lake: Lakehouse) -> None:
        daily.load_silver(lake, "2024-01-03")
        daily.load_dimensions(lake, "2024-01-03")
        daily.load_facts(lake, "2024-01-03")

    log = _two_landings(spark, sf, load).table(names.RUN_LOG)
    counts = [F.sum(c).alias(c) for c in ("rows_read", "rows_written", "rows_rejected")]
    return log.where("process_name <> 'gold_dimension_load'").groupBy("process_name").agg(F.count(F.lit(1)).alias("runs"), *counts)


# --- catalog tables ---------------------------------------------------------


def _table_name(label: str) -> str:
    """A table of its own for each run: managed folders outlive the session that made them."""
    return f"granary_workload.{label}_{uuid.uuid4().hex}"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return base.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query
def json_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table over JSON lines whose folder is then overwritten; defining it again changes nothing."""
    name, path = _table_name("customers"), scratch_path(spark, "json-table")
    customers = base.table(spark, sf, "customer")
    tables.overwrite_json(customers.where("c_acctbal < 0"), path)
    for _ in range(2):
        tables.create_json_table(spark, name, path, customers.schema)
    tables.overwrite_json(customers, path)
    spark.catalog.refreshTable(name)
    return spark.table(name)


@query
def append_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to a catalog table: columns in another order, then with one left out."""
    name = _table_name("orders")
    orders = _orders(spark, sf)
    for _ in range(2):
        tables.create_table(spark, name, orders.schema, scratch_path(spark, "orders"))
    finished = F.col("o_orderstatus") == "F"
    tables.append_table(orders.where(finished).select(*reversed(orders.columns)), name)
    tables.append_table(orders.where(~finished).drop("o_orderpriority"), name)
    return spark.table(name)


@query
def overwrite_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders kept by status; those of one status are loaded again, twice, at twice the price."""
    name = _table_name("by_status")
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    tables.create_table(spark, name, orders.schema, scratch_path(spark, "by-status"), ("o_orderstatus",))
    tables.replace_partitions(orders, name)
    again = orders.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        tables.replace_partitions(again, name)
    return spark.table(name)


@query
def replace_managed_table(spark: SparkSession, sf: str) -> DataFrame:
    """A managed table that a later load replaces, columns included."""
    name = _table_name("managed")
    tables.replace_table(base.table(spark, sf, "customer"), name)
    tables.replace_table(_orders(spark, sf), name)
    return spark.table(name)


@query
def publish_version(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by rows that are computed from itself: all orders, each a day later, three times over."""
    name, path = _table_name("versions"), scratch_path(spark, "versions")
    orders = _orders(spark, sf).select("o_orderkey", "o_orderdate")
    tables.create_table(spark, name, orders.schema, path)
    tables.publish(orders, name, path)
    for _ in range(3):
        tables.publish(spark.table(name).withColumn("o_orderdate", F.date_add("o_orderdate", 1)), name, path)
    return spark.table(name)


@query
def fixture_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as fixtures: a CSV with header, all text, and files with a JSON array for each region."""
    nations = base.table(spark, sf, "nation")
    as_csv, as_json = (scratch_path(spark, "nations") + suffix for suffix in (".csv", ".json"))
    nations.write.option("header", "true").csv(as_csv)
    row = F.struct("n_nationkey", "n_name")
    arrays = nations.groupBy("n_regionkey").agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.write.partitionBy("n_regionkey").text(as_json)
    read = load_fixture(spark, as_csv).select("n_nationkey", "n_name", "n_regionkey", F.lit("csv").alias("fixture"))
    typed = load_fixture(spark, as_json)
    return read.union(typed.select(*(F.col(c).cast("string") for c in nations.columns), F.lit("json")))


@query
def log_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Run log rows for each order date, written to the catalog log table and read back."""
    lake = _daily_lake(spark)
    days = _orders(spark, sf).select(F.col("o_orderdate").alias("day")).distinct()
    for status, as_of in ((S.STATUS_FAILED, "2024-01-01 01:00:00"), (S.STATUS_COMPLETED, "2024-01-02 01:00:00")):
        lake.log(control.run_entries(days, S.PROCESS_INGEST, status, as_of, F.lit(as_of).cast("timestamp")))
    return lake.table(names.RUN_LOG).select(
        "process_name", F.col("processed_file_table_date").alias("day"), "process_status"
    )


@query
def load_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by whether their stamps are one current time: all of them, as of the clock."""
    began = dt.datetime.now(dt.UTC).timestamp()
    rows = cleaning.clean_daily_pricing(base.raw_pricing(spark, sf))
    seconds = F.col("created_at").cast("double")
    current = (F.col("created_at") == F.col("updated_at")) & seconds.between(began - 1, F.lit(began + 86_400))
    return rows.groupBy(current.alias("current")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("created_at").alias("stamps")
    )


@query
def price_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Name of the price file of each order date, and the date read back from it."""
    days = _orders(spark, sf).select(F.col("o_orderdate").alias("day")).distinct()
    named = days.withColumn("file", price_file("day"))
    return named.select("day", "file", file_date(F.concat(F.lit("/landing/"), "file")).alias("parsed"))


@query
def stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the landing stream; the second one finds nothing new."""
    folder, sink, state = (scratch_path(spark, x) for x in ("landing", "bronze", "stream"))
    _write_files(_price_text(spark, sf), folder, list(S.PRICING_COLUMNS))
    for _ in range(2):
        land_available(spark, folder, sink, state).awaitTermination()
    return spark.read.parquet(sink).drop("source_file_load_date")


@query
def evolving_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to one folder; the second one brings a new column."""
    path = scratch_path(spark, "evolving")
    orders = base.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    late = F.year("o_orderdate") >= 1998
    append_files(orders.where(~late).drop("o_orderpriority"), path)
    append_files(orders.where(late), path)
    return read_evolving(spark, path)


@query
def partitioned_append(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed by day, read back from one day on by partition."""
    path = scratch_path(spark, "days")
    events = base.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    append_files(events, path, ("day",))
    landed = read_evolving(spark, path, events.schema)
    return landed.where(F.col("day") >= F.lit("2024-01-15").cast("date"))


@query
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "geo")
    base.geocoding(spark, sf).drop("reply").write.json(path)
    return nested.flatten_locations(read_json_lines(spark, path, S.GEOCODE_RESPONSE))


@query
def reference_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Copy of the part table, and of its JSON form, counted while written."""
    root = scratch_path(spark, "reference")
    part = base.table(spark, sf, "part")
    copied = copy_reference_table(part, root, "masterdata.part")
    typed = spark.read.parquet(copied.path)
    lines = copy_reference_table(part, root, "masterdata.part_lines", "json")
    both = [(typed, copied, "parquet"), (read_json_lines(spark, lines.path, part.schema), lines, "json")]
    first, second = (
        rows.withColumns({"rows_written": F.lit(c.rows).cast("bigint"), "form": F.lit(form)}) for rows, c, form in both
    )
    return first.unionByName(second)


@query
def request_urls(spark: SparkSession, sf: str) -> DataFrame:
    return req.weather_requests(nested.flatten_locations(base.geocoding(spark, sf)))


@query
def limit_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Requests for the first ten products taken as market names."""
    dim = _first_dim(spark, base.pricing(spark, sf), S.DIM_MARKET, "product_name")
    return req.geocode_requests(dim, limit=10)


# --- single steps -----------------------------------------------------------


@query
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return merging.product_pairs(base.pricing(spark, sf))


@query
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    """New and changed members side by side, matched by column name."""
    customers = base.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = base.table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)


@query
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose key is twice that of no customer with orders."""
    customers = base.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = base.table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("o_custkey"))
    return unmatched_right(orders, customers, [("o_custkey", "c_custkey")])


@query
def full_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and customers, whose keys are doubled so that both sides have rows without a match."""
    orders = base.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = base.table(spark, sf, "customer").select((F.col("c_custkey") * 2).alias("c_custkey"), "c_name")
    return full_outer(orders, customers, [("o_custkey", "c_custkey")])


@query
def left_star_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the supplier on a key expression; suppliers' keys are doubled, so that lines go without."""
    suppliers = base.table(spark, sf, "supplier")
    keyed = suppliers.select((F.col("s_suppkey") * 2).cast("string").alias("key"), "s_name")
    lines = base.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_suppkey").cast("string").alias("key")
    )
    return lookup(lines, keyed, ["key"], ["s_name"])


@query
def coalesce_max(spark: SparkSession, sf: str) -> DataFrame:
    """Highest key of a filled and of an emptied table."""
    orders = base.table(spark, sf, "orders")
    filled = highest_id(orders, "o_orderkey")
    emptied = highest_id(orders.where("o_totalprice < 0"), "o_orderkey")
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.lit(filled).cast("bigint").alias("filled_max"),
        F.lit(emptied).cast("bigint").alias("empty_max"),
    )
