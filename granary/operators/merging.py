"""Type-1 upsert of the product dimension, as joins over plain tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from granary import schemas as S
from granary.functions import load_time
from granary.operators.ids import dense_ids, highest_id
from granary.staging import empty_table, stage


def product_pairs(silver: DataFrame) -> DataFrame:
    """Distinct (product, group) pairs of the price rows, product not NULL."""
    return (
        silver.where(F.col("product_name").isNotNull())
        .select("product_name", "productgroup_name")
        .distinct()
    )


def one_group_per_product(pairs: DataFrame) -> DataFrame:
    """One row per product: its alphabetically first group, NULL only if it has no other."""
    return pairs.groupBy("product_name").agg(F.min("productgroup_name").alias("productgroup_name"))


def _same_pair(a: str, b: str):
    return (F.col(f"{a}.product_name") == F.col(f"{b}.product_name")) & F.col(
        f"{a}.productgroup_name"
    ).eqNullSafe(F.col(f"{b}.productgroup_name"))


def product_changes(pairs: DataFrame, dim: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """What one load changes in `dim`: (product_id, productgroup_name, product_name, is_new), written to the shared folder.

    A pair that `dim` holds changes nothing. A product with one row in `dim` and one source pair moves to the group of
    that pair. Every other pair is new, with the next free id. `history` is the type-2 history of `dim`: a pair that is current there
    already keeps the id it has there, which happens where a load got lost between the two tables.
    """
    by_name = Window.partitionBy("product_name")
    given = pairs.select("product_name", "productgroup_name").distinct().withColumn("_pairs", F.count(F.lit(1)).over(by_name))
    held = dim.groupBy("product_name").agg(F.count(F.lit(1)).alias("_rows"), F.min("product_id").alias("_held"))
    unseen = given.alias("p").join(dim.alias("d"), _same_pair("p", "d"), "left_anti").join(held, "product_name", "left")
    moved = (F.col("_pairs") == 1) & F.coalesce(F.col("_rows") == 1, F.lit(False))
    marked = unseen.select("product_name", "productgroup_name", F.when(moved, F.col("_held")).alias("product_id"), (~moved).alias("is_new"))
    top = [dim.select("product_id")]
    if history is not None:
        known = history.where("is_current").groupBy("product_name", "productgroup_name").agg(F.max("product_id").alias("_known"))
        marked = marked.alias("p").join(known.alias("d"), _same_pair("p", "d"), "left").select(
            "p.product_name", "p.productgroup_name", "is_new", F.coalesce("product_id", "_known").alias("product_id")
        )
        top.append(history.select("product_id"))
    marked = stage(marked, "marked")
    numbered = dense_ids(
        marked.where("product_id is null").drop("product_id"), ["product_name", "productgroup_name"], "product_id",
        highest_id(reduce(DataFrame.unionByName, top), "product_id"),
    )
    columns = ["product_id", "productgroup_name", "product_name", "is_new"]
    return stage(marked.where("product_id is not null").select(*columns).unionByName(numbered.select(*columns)), "changes")


def product_changes_by_load(
    pairs: DataFrame, dim: DataFrame, load_col: str, history: DataFrame | None = None
) -> DataFrame:
    """`product_changes` of several loads as if each had been merged in turn, plus `load_col`.

    pairs: (product, group, load). Only loads that bring a pair unknown at their turn cost a pass over the pairs.
    """
    columns = ["product_id", "productgroup_name", "product_name"]
    pairs = stage(pairs.select("product_name", "productgroup_name", load_col).distinct(), "pairs")
    state, last, found = dim.select(*columns), None, []
    while True:
        later = pairs if last is None else pairs.where(F.col(load_col) > F.lit(last))
        unknown = later.alias("p").join(state.alias("d"), _same_pair("p", "d"), "left_anti")
        last = unknown.agg(F.min(load_col)).first()[0]
        if last is None:
            break
        load = F.lit(last).cast(pairs.schema[load_col].dataType)
        changes = product_changes(pairs.where(F.col(load_col) == load), state, history)
        found.append(changes.withColumn(load_col, load))
        state = stage(_changed(state, changes).select(*columns), "state")
    if not found:
        return empty_table(
            dim.sparkSession,
            StructType([*[dim.schema[c] for c in columns], StructField("is_new", BooleanType()), pairs.schema[load_col]]),
        )
    return reduce(DataFrame.unionByName, found)


def _changed(dim: DataFrame, changes: DataFrame, stamps: dict | None = None) -> DataFrame:
    """`dim` with the changes of one load; `stamps` are columns of changed rows."""
    moved = changes.where("not is_new").select(F.col("product_id").alias("_id"), F.col("productgroup_name").alias("_group"))
    changed = F.col("_id").isNotNull()
    columns = {"productgroup_name": F.when(changed, F.col("_group")).otherwise(F.col("productgroup_name"))}
    for name, value in (stamps or {}).items():
        columns[name] = F.when(changed, value).otherwise(F.col(name)) if name == "updated_at" else F.col(name)
    updated = dim.join(moved, F.col("product_id") == F.col("_id"), "left").withColumns(columns).drop("_id", "_group")
    fresh = changes.where("is_new").select("product_id", "productgroup_name", "product_name").withColumns(stamps or {})
    return updated.unionByName(fresh.select(*dim.columns))


def apply_product_changes(
    dim: DataFrame, changes: DataFrame, as_of: dt.datetime | str | None = None, load_col: str | None = None
) -> DataFrame:
    """`dim` (or some of its buckets) after `changes`; with `load_col` after those of all its loads."""
    if load_col is not None:
        # A product's last group counts; it is new if any load brought it.
        changes = changes.groupBy("product_id").agg(
            F.max_by("productgroup_name", load_col).alias("productgroup_name"), F.max("product_name").alias("product_name"),
            F.bool_or("is_new").alias("is_new"),
        )
    now = load_time(as_of)
    return _changed(dim.select(*S.DIM_PRODUCT.fieldNames()), changes, {"created_at": now, "updated_at": now})


def merge_product_dim(
    pairs: DataFrame, dim: DataFrame, as_of: dt.datetime | str | None = None
) -> DataFrame:
    """`dim` after the upsert of `pairs`, which are keyed like the fact lookup by name and group; see `product_changes`."""
    return apply_product_changes(dim, product_changes(pairs, dim), as_of)
