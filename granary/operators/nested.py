"""Rows out of nested geocoding and weather responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import schemas as S

_WEATHER_SERIES = ("temperature_2m_max", "temperature_2m_min", "rain_sum")


def with_results(responses: DataFrame) -> DataFrame:
    """Responses that carry a result list, even one whose states are all NULL."""
    return responses.where(F.col("results.admin1").isNotNull())


def flatten_locations(responses: DataFrame) -> DataFrame:
    """One row per geocoding result.

    `inline` keeps the fields of one result together in one scan; no ids and no
    self-join are needed to put them back side by side.
    """
    return responses.select(F.inline("results")).select(
        F.col("admin1").alias("stateName"),
        F.col("admin2").alias("districtName"),
        F.col("country").alias("countryName"),
        "latitude",
        "longitude",
        F.col("name").alias("marketName"),
        "population",
    )


def flatten_weather(responses: DataFrame) -> DataFrame:
    """One row per market and day, the parallel daily lists aligned by position.

    A missing or short list gives NULLs for its days; `weather_length_mismatch`
    reports such responses. `sequenceId` is unique but carries no meaning.
    """
    lists = [
        F.coalesce(F.col(f"daily.{name}"), F.array().cast(S.WEATHER_DAILY[name].dataType)).alias(name)
        for name in _WEATHER_SERIES
    ]
    return (
        responses.where(F.col("daily.time").isNotNull())
        .select(
            "marketName",
            "latitude",
            "longitude",
            F.col("daily_units.temperature_2m_max").alias("unitOfTemparature"),
            F.col("daily_units.rain_sum").alias("unitOfRainFall"),
            F.col("daily.time").alias("time"),
            *lists,
        )
        .select(
            "marketName",
            "latitude",
            "longitude",
            "unitOfTemparature",
            "unitOfRainFall",
            F.inline(F.arrays_zip("time", *_WEATHER_SERIES)),
        )
        .select(
            "marketName",
            "latitude",
            "longitude",
            F.col("time").alias("weatherDate"),
            F.col("temperature_2m_max").alias("maximumTemparature"),
            "unitOfTemparature",
            F.col("temperature_2m_min").alias("minimumTemparature"),
            F.col("rain_sum").alias("rainFall"),
            "unitOfRainFall",
            F.monotonically_increasing_id().alias("sequenceId"),
        )
    )


def weather_length_mismatch(responses: DataFrame) -> DataFrame:
    """Responses whose daily lists are missing or of unequal length."""
    days = F.array_size("daily.time")
    same = [days.eqNullSafe(F.array_size(f"daily.{name}")) for name in _WEATHER_SERIES]
    return responses.where(days.isNull() | ~reduce(lambda a, b: a & b, same))


def _product_size(lists: list[str]) -> Column:
    sizes = (F.coalesce(F.array_size(c), F.lit(0)).cast("bigint") for c in lists)
    return reduce(lambda a, b: a * b, sizes)


def explode_cross(df: DataFrame, lists: list[str], limit: int, order_by: list[str]) -> DataFrame:
    """The first `limit` rows of the cross product of the list columns of each row.

    Rows come in the order of `order_by` (which should identify an input row) and
    then of the list positions, the last list running fastest; `sequenceId` is
    that order from 0. The product itself is never formed: the positions of
    output row i follow from dividing i by the list lengths, and since every row
    with a non-empty product fills at least one place, the first `limit` of them
    are enough.
    """
    others = [c for c in df.columns if c not in lists]
    first = df.withColumn("_rows", _product_size(lists)).where("_rows > 0")
    first = first.orderBy(*order_by).limit(limit)
    last = F.least(F.col("_rows"), F.lit(limit)) - 1
    numbered = first.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))

    picked: list[Column] = []
    stride: Column = F.lit(1).cast("bigint")
    for name in reversed(lists):
        size = F.array_size(name).cast("bigint")
        position = (F.floor(F.col("_i") / stride) % size).cast("int")
        picked.insert(0, F.get(F.col(name), position).alias(name))
        stride = stride * size
    rows = numbered.select(*others, *picked, "_i").orderBy(*order_by, "_i").limit(limit)
    return rows.withColumn("sequenceId", F.monotonically_increasing_id()).drop("_i")
