"""Type-2 history: expire changed current rows, add new versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import load_time
from granary.operators.checks import require_unique
from granary.operators.ids import dense_ids, highest_id
from granary.staging import stage

TRACKED = ("productgroup_name",)


def product_source(dim_product: DataFrame) -> DataFrame:
    """Distinct product rows to track, product name not NULL."""
    return (
        dim_product.where(F.col("product_name").isNotNull())
        .select("product_id", "product_name", "productgroup_name")
        .distinct()
    )


def new_versions(
    src: DataFrame,
    current: DataFrame,
    load_col: str,
    key: str = "product_id",
    tracked: tuple[str, ...] = TRACKED,
    first_sk: int = 0,
    sk_col: str = "product_sk",
    skip_seen: bool = True,
) -> DataFrame:
    """All versions that the loads in `src` add, each with `load_col` as its start and `_until`, the start of the next, or NULL.

    A key's rows, its current version first and then its loads in order, are compared each with the one before:
    where tracked values differ, a version begins. Values are compared NULL-safe. Keys are unique within a load.
    With `skip_seen`, loads not after the start of the current version are in it already. Numbers run by load, then key.
    Of the history only current versions of the keys in `src` are moved. The result is written to the shared folder.
    """
    src = src.where(F.col(key).isNotNull())
    held = current.join(src.select(key).distinct(), key, "left_semi")
    values = F.struct(*tracked)
    seen = held.select(key, values.alias("_values"), F.lit(False).alias("_new"), F.col("effective_start_date").alias("_load"), F.lit(None).alias("_row"))
    given = src.select(
        key, values.alias("_values"), F.lit(True).alias("_new"), F.col(load_col).cast("timestamp").alias("_load"), F.struct(*src.columns).alias("_row")
    )
    in_order = Window.partitionBy(key).orderBy("_new", "_load")
    begun = F.max(F.when(~F.col("_new"), F.col("_load"))).over(Window.partitionBy(key))
    late = F.coalesce(F.col("_load") > begun, F.lit(True)) if skip_seen else F.lit(True)
    rows = given.unionByName(seen).withColumn("_late", late).where("not _new or _late")
    before = rows.withColumns({"_before": F.lag("_values").over(in_order), "_first": F.row_number().over(in_order) == 1})
    changes = before.where(F.col("_new") & (F.col("_first") | ~F.col("_values").eqNullSafe(F.col("_before"))))
    timed = changes.withColumn("_until", F.lead("_load").over(Window.partitionBy(key).orderBy("_load")))
    return stage(dense_ids(timed.select("_row.*", "_until", "_load"), ["_load", key], sk_col, first_sk), "versions")


def with_versions(
    hist: DataFrame,
    versions: DataFrame,
    key: str = "product_id",
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """`hist`, or the part of it that holds the keys of `versions`, after those: replaced versions end where the next begins."""
    now = load_time(as_of)
    ends = versions.groupBy(key).agg(F.min("_load").alias("_end"))
    expire = F.col("is_current") & F.col("_end").isNotNull()
    stamps = {
        "effective_end_date": F.when(expire, F.col("_end")).otherwise(F.col("effective_end_date")),
        "updated_at": F.when(expire, now).otherwise(F.col("updated_at")),
        "is_current": F.when(expire, F.lit(False)).otherwise(F.col("is_current")),
    }
    kept = hist.join(ends, key, "left").withColumns(stamps).select(*hist.columns)
    added = versions.withColumns(
        {
            "effective_start_date": F.col("_load"),
            "effective_end_date": F.col("_until"),
            "is_current": F.col("_until").isNull(),
            "created_at": now,
            "updated_at": now,
        }
    )
    return kept.unionByName(added.select(*hist.columns))


def scd2_apply_loads(
    src: DataFrame,
    hist: DataFrame,
    load_col: str,
    key: str = "product_id",
    tracked: tuple[str, ...] = TRACKED,
    as_of: dt.datetime | str | None = None,
    sk_col: str = "product_sk",
    skip_seen: bool = True,
) -> DataFrame:
    """History after all loads in `src` at once, as if they had been applied one by one; see `new_versions`.

    `src` has a row per key and load. Versions start at their load's stamp. A second run changes nothing.
    """
    require_unique(src, [key, load_col], "several source rows version one key")
    current = hist.where("is_current")
    versions = new_versions(src, current, load_col, key, tracked, highest_id(hist, sk_col), sk_col, skip_seen)
    return with_versions(hist, versions, key, as_of)


def scd2_apply(
    src: DataFrame,
    hist: DataFrame,
    key: str = "product_id",
    tracked: tuple[str, ...] = TRACKED,
    as_of: dt.datetime | str | None = None,
    sk_col: str = "product_sk",
) -> DataFrame:
    """History after one load. A second run with the same source changes nothing."""
    loaded = src.withColumn("_loaded", load_time(as_of))
    return scd2_apply_loads(loaded, hist, "_loaded", key, tracked, as_of, sk_col, skip_seen=False)
