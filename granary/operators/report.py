"""Prices enriched with location and weather."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import stamped
from granary.operators.lookups import pairs_equal, unmatched_right
from granary.staging import stage

_PRICE = [name.lower() for name in S.PRICING_COLUMNS]
_GEO_KEYS = [("state_name", "_state"), ("market_name", "_market")]
_WEATHER_KEYS = [("market_name", "_market"), ("date_of_pricing", "_day")]
_GEO_TAKE = ["MARKET_LATITUDE", "MARKET_LONGITUDE", "MARKET_POPULATION"]
_WEATHER_TAKE = [
    "TEMPARATURE_UNIT",
    "MARKET_MAX_TEMPARATURE",
    "MARKET_MIN_TEMPARATURE",
    "RAINFALL_UNIT",
    "MARKET_DAILY_RAINFALL",
]


def _locations(geo: DataFrame) -> DataFrame:
    return geo.select(
        F.col("stateName").alias("_state"),
        F.col("marketName").alias("_market"),
        F.col("latitude").alias("MARKET_LATITUDE"),
        F.col("longitude").alias("MARKET_LONGITUDE"),
        F.col("population").alias("MARKET_POPULATION"),
    )


def _weather(weather: DataFrame) -> DataFrame:
    return weather.select(
        F.col("marketName").alias("_market"),
        F.expr("try_cast(weatherDate AS DATE)").alias("_day"),
        F.col("unitOfTemparature").alias("TEMPARATURE_UNIT"),
        F.col("maximumTemparature").alias("MARKET_MAX_TEMPARATURE"),
        F.col("minimumTemparature").alias("MARKET_MIN_TEMPARATURE"),
        F.col("unitOfRainFall").alias("RAINFALL_UNIT"),
        F.col("rainFall").alias("MARKET_DAILY_RAINFALL"),
    )


#: Parts of one market and day, so that a hot one is no single task's: prices fall into one each, its context is copied to all.
SALTS = 8

_LAYOUT = ["_state_key", "_market_key", "_day_key", "_nulls", "_part"]


def _keyed(rows: DataFrame, part: Column) -> DataFrame:
    """Adds _LAYOUT: state, market and day as keys that equal NULL for NULL, and the part."""
    nulls = sum((F.when(F.col(c).isNull(), bit).otherwise(0) for c, bit in (("state_name", 1), ("market_name", 2), ("date_of_pricing", 4))), F.lit(0))
    return rows.withColumns({
        "_state_key": F.coalesce("state_name", F.lit("")), "_market_key": F.coalesce("market_name", F.lit("")),
        "_day_key": F.coalesce("date_of_pricing", F.lit("0001-01-01").cast("date")), "_nulls": nulls, "_part": part,
    })


def price_weather_report(
    silver: DataFrame,
    geo: DataFrame,
    weather: DataFrame,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Distinct rows of prices ⟗ locations (state and market) ⟗ weather (market and day).

    Built so that the price table, the large one, is shuffled once and scanned twice:

    * One scan gives the price keys, of which there are as many as states, markets and days, and whether there is a price
      row that is NULL throughout. Locations and weather are joined to the keys, not to the prices.
    * Prices are then laid out by (state, market, day, part). A row fixes all of these, so the distinct and the join with the keys'
      context both find that layout and add no exchange; the parts spread a hot market and day. A price row fixes its
      keys, so distinct prices joined with distinct contexts are distinct.
    * Rows without a price come from anti joins against the keys. Only these rows can still coincide, so the last
      distinct runs over them alone.

    Weather is matched by market name only, as is the state of a location row
    without a price: markets of the same name share their weather. A day that
    does not parse matches no price.
    """
    places = _locations(geo).distinct()
    days = _weather(weather).distinct()
    has_value = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in _PRICE))

    prices = silver.select(*_PRICE)
    keys = stage(prices.select("state_name", "market_name", "date_of_pricing", has_value.alias("_some")).distinct(), "price-keys")
    named = keys.where("_some").drop("_some")
    context = (
        named.alias("l")
        .join(places.alias("r"), pairs_equal("l", "r", _GEO_KEYS), "left").select("l.*", *_GEO_TAKE)
        .alias("l")
        .join(days.alias("r"), pairs_equal("l", "r", _WEATHER_KEYS), "left").select("l.*", *_GEO_TAKE, *_WEATHER_TAKE)
    )
    every_part = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))
    parted = _keyed(context, every_part).select(*_LAYOUT, *_GEO_TAKE, *_WEATHER_TAKE)
    one_part = F.pmod(F.xxhash64(*_PRICE), F.lit(SALTS))
    laid_out = _keyed(prices.where(has_value), one_part).repartition(*_LAYOUT).distinct()
    priced = laid_out.join(parted, _LAYOUT, "left").select(*_PRICE, *_GEO_TAKE, *_WEATHER_TAKE)

    nothing = [F.lit(None).cast(silver.schema[c].dataType).alias(c) for c in _PRICE]
    unpriced = (
        unmatched_right(named, places, _GEO_KEYS).select(*_GEO_TAKE)
        .unionByName(
            unmatched_right(named, days, _WEATHER_KEYS).select(*_WEATHER_TAKE),
            allowMissingColumns=True,
        )
        .unionByName(keys.where("not _some").select(*nothing), allowMissingColumns=True)
        .distinct()
    )
    report = priced.unionByName(unpriced, allowMissingColumns=True)
    stamped_report = stamped(report, as_of, ("lakehouse_inserted_date", "lakehouse_updated_date"))
    return stamped_report.select(*S.PRICE_WEATHER_REPORT.fieldNames())
