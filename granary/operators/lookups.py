"""Joins of a large table with dimension tables.

No join carries a broadcast hint: Spark compares the size of the dimension table
with `spark.sql.autoBroadcastJoinThreshold` and joins map-side below it. Above
it the join shuffles, and the skew handling of adaptive execution splits the
partition of a hot (or NULL) key on the large side, which is legal for inner and
left outer joins but not for full outer ones; hence `full_outer` below.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, keys: list[str], take: list[str]) -> DataFrame:
    """Left join: `fact` with the columns `take` of the `dim` row with equal `keys`.

    Rows without a match stay, with NULLs; a NULL key matches nothing.
    """
    return fact.join(dim.select(*keys, *take), list(keys), "left")


def validity(versions: DataFrame, keys: list[str], take: list[str], start: str) -> DataFrame:
    """Versions as spans without gap or overlap: (keys, take, _from, _to). The first of a key reaches back without end
    (_from is NULL), the last on without end. Of versions that start at once the one with the largest `take` counts."""
    once = versions.groupBy(*keys, start).agg(F.max(F.struct(*take)).alias("_take"))
    in_order = Window.partitionBy(*keys).orderBy(start)
    return once.select(
        *keys, *[F.col("_take")[c].alias(c) for c in take],
        F.when(F.row_number().over(in_order) > 1, F.col(start)).alias("_from"), F.lead(start).over(in_order).alias("_to"),
    )


def lookup_as_of(
    fact: DataFrame,
    versions: DataFrame,
    keys: list[str],
    take: list[str],
    at: str,
    start: str,
    null_safe: tuple[str, ...] = (),
) -> DataFrame:
    """Left join: `fact` with `take` of the version of equal `keys` that held at `at`.

    That is the last version started by then, else the first one started after; a row without a time takes the last. Keys in
    `null_safe` equal NULL for NULL. Every row meets one span of its key at most, so none is multiplied: an equality
    join with a residual on two stamps, which Spark can broadcast, sort and split like any other.
    """
    spans = validity(versions, keys, take, start)
    spans = spans.select(*[F.col(c).alias(f"_{c}") for c in keys], *take, "_from", "_to")
    time = F.coalesce(F.col(at), F.lit("9999-12-31").cast("timestamp"))
    match = (F.col("_from").isNull() | (time >= F.col("_from"))) & (F.col("_to").isNull() | (time < F.col("_to")))
    for c in keys:
        match = match & (F.col(c).eqNullSafe(F.col(f"_{c}")) if c in null_safe else F.col(c) == F.col(f"_{c}"))
    return fact.join(spans, match, "left").drop("_from", "_to", *[f"_{c}" for c in keys])


def pairs_equal(left: str, right: str, keys: list[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, b: a & b, (F.col(f"{left}.{l}") == F.col(f"{right}.{r}") for l, r in keys)
    )


def unmatched_right(
    left_keys: DataFrame, right: DataFrame, keys: list[tuple[str, str]]
) -> DataFrame:
    """Rows of `right` that no row of `left_keys` matches."""
    present = left_keys.select(*(l for l, _ in keys)).distinct()
    return right.alias("r").join(present.alias("l"), pairs_equal("l", "r", keys), "left_anti")


def full_outer(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Full outer join on pairs of (left, right) key columns with distinct names.

    A left outer join plus the right rows without a partner. Unlike the native
    full outer join, the left part can broadcast a small right side, so a large
    left table is not shuffled, and a hot key can be split; the second part only
    aggregates the key columns of the left table.
    """
    matched = left.alias("l").join(right.alias("r"), pairs_equal("l", "r", keys), "left")
    return matched.unionByName(unmatched_right(left, right, keys), allowMissingColumns=True)
