"""Copies of relational reference tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary import schemas as S
from granary.sinks.tables import sink_path
from granary.sources.jdbc import Slices, read_jdbc_table


@dataclass(frozen=True)
class Copied:
    """Where a table was written and how many rows it has."""

    table: str
    path: str
    rows: int


def copy_reference_table(
    df: DataFrame, root: str, table: str, file_format: str = "parquet"
) -> Copied:
    """Overwrite the folder of `table` below `root`.

    The rows are counted by the write itself, so the source is scanned once.
    Parquet keeps the column types of the database; "json" writes JSON lines.
    """
    seen = Observation(f"copy {table}")
    path = sink_path(root, table)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").format(file_format).save(path)
    return Copied(table, path, seen.get["rows"])


def copy_reference_data(
    spark: SparkSession, url: str, root: str, properties: dict[str, str],
    tables: tuple[str, ...] = S.REFERENCE_TABLES,
    slices: dict[str, Slices] | None = None, file_format: str = "parquet",
) -> list[Copied]:
    """Copy each table over JDBC; `slices` says how to read the large ones in parallel."""
    return [
        copy_reference_table(
            read_jdbc_table(spark, url, table, properties, (slices or {}).get(table)),
            root, table, file_format,
        )
        for table in tables
    ]
