"""Lakehouse inputs derived from the test tables.

The price rows are order lines: state and market are the region and nation of
the customer, group, product and variety the type, name and brand of the part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import schemas as S
from granary.staging import stage

AS_OF = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pricing(spark: SparkSession, sf: str) -> DataFrame:
    """Typed price rows without load stamps."""
    read = lambda name: table(spark, sf, name)
    # Places are joined to the orders, so the lines meet them in one join. Both of
    # its sides grow with the data; the hint keeps the planner, which multiplies
    # the sizes of the joined tables, from broadcasting the lines.
    ordered = (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_orderdate", "n_name", "r_name")
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    one = F.lit(1).cast("decimal(4,2)")
    return (
        read("lineitem").repartition("l_orderkey")
        .join(ordered.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_orderdate").cast("date").alias("date_of_pricing"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
            F.col("r_name").alias("state_name"),
            F.col("n_name").alias("market_name"),
            F.col("p_type").alias("productgroup_name"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("variety"),
            F.col("s_name").alias("origin"),
            F.col("l_quantity").cast(S.TONNES).alias("arrival_in_tonnes"),
            (price * (one - F.col("l_discount").cast("decimal(4,2)"))).cast(S.MONEY).alias("minimum_price"),
            (price * (one + F.col("l_tax").cast("decimal(4,2)"))).cast(S.MONEY).alias("maximum_price"),
            F.col("l_extendedprice").cast(S.MONEY).alias("modal_price"),
        )
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The price rows as a written table, as the dimension and fact loads expect them."""
    return stage(pricing(spark, sf), "silver")


def raw_pricing(spark: SparkSession, sf: str) -> DataFrame:
    """Price rows as file text, some of it not valid.

    Dates of failed orders are written year first, those of open orders without
    leading zeros; the quantity of returned lines carries a unit; prices keep
    four decimals, so cleaning has to round.
    """
    read = lambda name: table(spark, sf, name)
    day = F.col("o_orderdate").cast("date")
    four = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    amount = F.col("l_quantity").cast(S.TONNES).cast("string")
    return (
        read("lineitem").repartition("l_orderkey")
        .join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd"))
            .otherwise(F.date_format(day, S.PRICING_DATE_FORMAT))
            .alias("DATE_OF_PRICING"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("ROW_ID"),
            F.col("o_orderpriority").alias("STATE_NAME"),
            F.col("l_linestatus").alias("MARKET_NAME"),
            F.col("p_type").alias("PRODUCTGROUP_NAME"),
            F.col("p_name").alias("PRODUCT_NAME"),
            F.col("p_brand").alias("VARIETY"),
            F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_returnflag")).alias("ORIGIN"),
            F.when(F.col("l_returnflag") == "R", F.concat(amount, F.lit(" t"))).otherwise(amount).alias("ARRIVAL_IN_TONNES"),
            F.when(F.col("l_discount") > 0, four.cast("string")).alias("MINIMUM_PRICE"),
            (F.col("l_extendedprice").cast("decimal(18,2)") + four).cast("string").alias("MAXIMUM_PRICE"),
            F.concat(F.lit("-"), four.cast("string")).alias("MODAL_PRICE"),
            F.col("l_shipdate").alias("source_file_load_date"),
        )
    )


def run_log(spark: SparkSession, sf: str, completed_above: float = 5) -> DataFrame:
    """One run per event: its type is the process, low values are failures."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("process_name"),
        F.col("ts").cast("date").alias("processed_file_table_date"),
        F.when(F.col("value") > completed_above, S.STATUS_COMPLETED).otherwise(S.STATUS_FAILED).alias("process_status"),
        F.col("ts").cast("timestamp").alias("run_timestamp"),
        F.col("ts").cast("timestamp").alias("watermark_ts"),
    )


def geocoding(spark: SparkSession, sf: str) -> DataFrame:
    """Geocoding responses: customers in lists of ten consecutive keys, as one service reply holds.

    State and district are missing where the customer has no positive balance.
    """
    read = lambda name: table(spark, sf, name)
    located = (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    result = F.struct(
        F.when(F.col("c_acctbal") > 0, F.col("r_name")).alias("admin1"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("admin2"),
        F.col("c_name").alias("country"),
        (F.col("c_custkey") / 8).alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
        F.col("n_name").alias("name"),
        F.col("c_custkey").alias("population"),
    )
    return (
        located.select(F.expr("c_custkey div 10").alias("reply"), "c_custkey", result.alias("result"))
        .groupBy("reply")
        .agg(F.array_sort(F.collect_list(F.struct("c_custkey", "result"))).alias("sorted"))
        .select("reply", F.col("sorted.result").alias("results"))
    )


def market_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Geocoding responses by state: its markets, located by their customers.

    A state is a region, or a market segment; segments have no price rows.
    """
    read = lambda name: table(spark, sf, name)
    markets = (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.explode(F.array("r_name", "c_mktsegment")).alias("state"), "n_name", "c_acctbal")
        .groupBy("state", "n_name")
        .agg(
            F.min("c_acctbal").alias("low"),
            F.max("c_acctbal").alias("top"),
            F.count(F.lit(1)).alias("customers"),
        )
    )
    result = F.struct(
        F.col("state").alias("admin1"),
        F.lit(None).cast("string").alias("admin2"),
        F.lit(None).cast("string").alias("country"),
        F.col("low").alias("latitude"),
        F.col("top").alias("longitude"),
        F.col("n_name").alias("name"),
        F.col("customers").alias("population"),
    )
    return markets.groupBy("state").agg(F.collect_list(result).alias("results"))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Weather responses: per market and year the days with orders, at most 366.

    The maximum is the largest, the minimum the smallest order total of the day,
    and the rainfall the number of orders, which is missing on days with one.
    """
    read = lambda name: table(spark, sf, name)
    daily = (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", F.col("o_orderdate").cast("date").alias("day"))
        .agg(
            F.max("o_totalprice").alias("top"),
            F.min("o_totalprice").alias("low"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    entry = F.struct(
        F.col("day").cast("string").alias("time"),
        "top",
        "low",
        F.when(F.col("orders") > 1, F.col("orders").cast("double")).alias("rain"),
    )
    year = F.year("day")
    return (
        daily.groupBy("n_name", year.alias("year"))
        .agg(F.array_sort(F.collect_list(entry)).alias("days"))
        .select(
            F.col("n_name").alias("marketName"),
            (F.col("year") / 4).alias("latitude"),
            (F.col("year") / 8).alias("longitude"),
            F.struct(
                F.col("days.time").alias("time"),
                F.col("days.top").alias("temperature_2m_max"),
                F.col("days.low").alias("temperature_2m_min"),
                F.col("days.rain").alias("rain_sum"),
            ).alias("daily"),
            F.struct(F.lit("°C").alias("temperature_2m_max"), F.lit("mm").alias("rain_sum")).alias("daily_units"),
        )
    )
