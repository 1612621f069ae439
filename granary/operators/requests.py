"""Request addresses for the geocoding and weather services.

The tables say what to ask for; sending the requests and landing the responses
as JSON lines is left to the caller.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import schemas as S


def first_rows(df: DataFrame, order_by: list[str], limit: int | None) -> DataFrame:
    """All rows, or the first `limit` in a fixed order."""
    return df if limit is None else df.orderBy(*order_by).limit(limit)


def geocode_requests(
    dim_market: DataFrame,
    limit: int | None = None,
    base_url: str = S.GEOCODE_URL,
    options: str = S.GEOCODE_OPTIONS,
) -> DataFrame:
    """One address per market name, the name URL-encoded."""
    markets = first_rows(dim_market.select(F.col("market_name").alias("marketName")), ["marketName"], limit)
    name = F.replace(F.url_encode("marketName"), F.lit("+"), F.lit("%20"))
    return markets.withColumn("url", F.concat(F.lit(base_url), name, F.lit(options)))


def weather_requests(
    locations: DataFrame,
    start: dt.date | str = S.WEATHER_START,
    end: dt.date | str = S.WEATHER_END,
    limit: int | None = None,
    base_url: str = S.WEATHER_URL,
    options: str = S.WEATHER_OPTIONS,
) -> DataFrame:
    """One address per location for the days from `start` to `end`."""
    places = locations.select("latitude", "longitude", "marketName")
    places = first_rows(places, ["marketName", "latitude", "longitude"], limit)
    return places.withColumn(
        "url",
        F.concat(
            F.lit(base_url), F.col("latitude").cast("string"),
            F.lit("&longitude="), F.col("longitude").cast("string"),
            F.lit(f"&start_date={start}&end_date={end}{options}"),
        ),
    )
