"""Relational reference tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """How to cut a table into parallel reads: stride ranges of a numeric or date column.

    Rows outside the bounds are still read, by the first and last slice.
    """

    column: str
    lower: int | str
    upper: int | str
    count: int


def jdbc_options(
    url: str, table: str, properties: dict[str, str] | None = None,
    slices: Slices | None = None, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; credentials come from the caller in `properties`."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if slices:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": str(slices.lower),
            "upperBound": str(slices.upper),
            "numPartitions": str(slices.count),
        }
    return options


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    slices: Slices | None = None, fetch_size: int = 10_000,
) -> DataFrame:
    """A whole table; without `slices` one task reads it all, so give them for large tables."""
    options = jdbc_options(url, table, properties, slices, fetch_size)
    return spark.read.format("jdbc").options(**options).load()
