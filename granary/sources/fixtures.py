"""Small test inputs from files."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array or a CSV with header (all columns text); any other suffix is an error."""
    suffix = pathlib.PurePath(path).suffix.lower()
    if suffix == ".json":
        return spark.read.option("multiLine", "true").json(str(path))
    if suffix == ".csv":
        return spark.read.option("header", "true").csv(str(path))
    raise ValueError(f"Unsupported fixture type for: {path}")
