"""Dense surrogate keys in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.staging import stage

# Documented layout of monotonically_increasing_id: partition number in the
# upper bits, row number within the partition in the lower 33 bits.
_ROW_BITS = 33


def highest_id(df: DataFrame, id_col: str) -> int:
    """The largest id in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("top")).first()["top"]


def dense_ids(df: DataFrame, order_by: list[str], id_col: str, start: int = 0) -> DataFrame:
    """`df` plus `id_col` = start + 1, start + 2, … in the order of `order_by`.

    `order_by` should identify a row. Keys are range partitioned and staged; each range
    numbers its own rows and adds the number of rows in the ranges before it. Totals
    and ids both come from the staged ranges, so they agree on one and the same split.
    """
    slot = F.monotonically_increasing_id()
    ranged = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", slot)
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS)),
        "ranges",
    )
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per range partition, so the running total and its broadcast are
    # bounded by the partition count, not by the data.
    totals = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = totals.select("_part", before.alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + row + F.lit(start + 1)).alias(id_col), *df.columns
    )
