"""Key checks. Each is one aggregate with map-side combine and no join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A table holds a key more than once where one row per key is needed."""


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys match nothing and are left out."""
    present = df.select(*keys).na.drop(how="any")
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """`df` itself, or an error that names one repeated key."""
    require_all_unique({what: (df, keys)})
    return df


def require_all_unique(tables: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """An error that names one repeated key of one of the tables; one job for all of them."""
    found = [
        repeated_keys(df, keys).select(
            F.lit(what).alias("what"), F.to_json(F.struct(*keys, "copies")).alias("key")
        )
        for what, (df, keys) in tables.items()
    ]
    first = reduce(DataFrame.unionByName, found).take(1)
    if first:
        raise DuplicateKeyError(f"{first[0]['what']}: {first[0]['key']}")
