"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """A catalog table, or some of its columns."""
    df = spark.table(name)
    return df.select(*columns) if columns else df
