"""The location and weather load: responses, flat tables, report.

Requests are tables of addresses; whoever sends them lands the answers as text
lines, which is where `load_locations` and `load_weather` start.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from granary import schemas as S
from granary.operators import nested, requests
from granary.operators.report import price_weather_report
from granary.plans import lakehouse as names
from granary.plans.lakehouse import Lakehouse
from granary.sources.json_docs import parse_responses, read_responses, write_responses

AsOf = dt.datetime | str | None


def market_requests(lake: Lakehouse, limit: int | None = None) -> DataFrame:
    """Geocoding addresses for the markets of the dimension."""
    return requests.geocode_requests(lake.table(names.DIM_MARKET), limit)


def load_locations(lake: Lakehouse, lines: DataFrame) -> None:
    """Land geocoding response lines (column `value`) beside those that are no response, and rebuild the location table."""
    write_responses(parse_responses(lines, S.GEOCODE_RESPONSE), lake.bronze_locations)
    responses = nested.with_results(read_responses(lake.spark, lake.bronze_locations, S.GEOCODE_RESPONSE))
    lake.publish(nested.flatten_locations(responses), names.LOCATIONS)


def location_requests(
    lake: Lakehouse, start: dt.date | str = S.WEATHER_START, end: dt.date | str = S.WEATHER_END,
    limit: int | None = None,
) -> DataFrame:
    """Weather addresses for the locations; needs `load_locations` first."""
    return requests.weather_requests(lake.table(names.LOCATIONS), start, end, limit)


def load_weather(lake: Lakehouse, lines: DataFrame) -> None:
    """Land weather response lines (columns `marketName`, `value`), rejects beside them, and rebuild the table."""
    write_responses(parse_responses(lines, S.WEATHER_RESPONSE, tags=("marketName",)), lake.bronze_weather)
    responses = read_responses(lake.spark, lake.bronze_weather, S.WEATHER_RESPONSE)
    lake.publish(nested.flatten_weather(responses), names.WEATHER)


def build_report(lake: Lakehouse, as_of: AsOf = None) -> None:
    """Rebuild the price and weather report."""
    report = price_weather_report(
        lake.table(names.SILVER), lake.table(names.LOCATIONS), lake.table(names.WEATHER), as_of
    )
    lake.publish(report, names.REPORT)


def run_places(
    lake: Lakehouse, geocoding_lines: DataFrame, weather_lines: DataFrame, as_of: AsOf = None
) -> None:
    """Locations, then weather, then the report that needs both."""
    lake.create()
    load_locations(lake, geocoding_lines)
    load_weather(lake, weather_lines)
    build_report(lake, as_of)
