"""Helpers the operators share: shipped code, staged tables, running sums, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.staging import stage

_shipped: set[str] = set()

#: Bits of the bitmap by which `likely` knows ids: 2 MB, whatever the number of ids.
ID_BITS = 1 << 24
#: Bits that Spark's bitmap functions hold in a row.
_BITMAP_ROW = 1 << 15


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, through Spark's file server."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="granary-code-"), "granary_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """`df` dealt out anew over at least the session's shuffle partitions."""
    return df.repartition(width(df.sparkSession), *columns)


def likely(
    rows: DataFrame, id_col: str, ids: DataFrame, made: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: str | None = None
) -> DataFrame:
    """Those of `rows` whose id is in `ids` (its only column), and a few others whose id has the same bit in a bitmap.

    Rows are not shuffled, so a join that follows moves them alone. The driver gets ID_BITS / 8 bytes at most. A null id is in no list.
    `made` turns each batch of them into one of `schema`, in the same worker: two functions in a row hold two workers a task, and
    an executor keeps all that it ever needed at once.
    """
    bit = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(ID_BITS)).alias("_bit")
    name = ids.columns[0]
    found = ids.where(F.col(name).isNotNull()).select(bit(name)).groupBy(F.expr("bitmap_bucket_number(_bit)").alias("part"))
    # Spark counts buckets of positive bits from 1; bit 0 has bucket 0 for itself.
    table = np.zeros(ID_BITS // _BITMAP_ROW + 2, f"V{_BITMAP_ROW // 8}")
    for row in found.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_bit))").alias("bits")).collect():
        table[row["part"]] = np.void(bytes(row["bits"]))
    shared = rows.sparkSession.sparkContext.broadcast(table.view(np.uint8))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            place, part = (batch.column(batch.num_columns - k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
            held = (bits[part * (_BITMAP_ROW // 8) + place // 8] >> (place % 8).astype(np.uint8)) & 1
            found = batch.select(range(batch.num_columns - 2)).filter(pa.array(held.astype(bool)))
            yield made(found) if made else found

    at = [F.expr("bitmap_bucket_number(_bit)").alias("_part"), F.expr("bitmap_bit_position(_bit)").alias("_place")]
    marked = rows.where(F.col(id_col).isNotNull()).select("*", bit(id_col)).select(*rows.columns, *at)
    return marked.mapInArrow(kept, schema or rows.schema)


def running_start(
    df: DataFrame, group: list[str], order: list[str], value: str, out: str
) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows before this one in its group.

    Rows are range partitioned by (group, order) and written; each partition's sum per group
    shifts the rows of later partitions. A group that holds a third of all rows
    is spread over many partitions. (group, order) must be unique, or ties fall either way.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(width(df.sparkSession), *keys).withColumn(
        "_part", F.spark_partition_id()
    )
    rows = stage(ranged, "ranged")
    by_group = [F.col(c) for c in group]
    sums = rows.groupBy("_part", *group).agg(F.sum(value).alias("_sum"))
    # One row per partition and group in it.
    before = Window.partitionBy(*(by_group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"),
    )
    match = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    within = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(shifts, match)
        .withColumn(out, F.col("_shift") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_p", "_shift", "_part", *[f"_g{i}" for i in range(len(group))])
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of the links a - b: one row (node, component) per node in a link.

    Component is the smallest node reachable. Alternating large-star and small-star rounds
    rewrite the links until each node points at its smallest member; every round is written
    to the shared folder. The hub of a hot component is only ever the small end of a row, and
    the minimum per node is combined before the shuffle. Empty input gives no rows.
    """
    links = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct(),
        "links",
    )
    state = _fingerprint(links)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every larger neighbour of u is linked to the smallest of u's neighbourhood.
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stage(large.distinct(), "large")
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _fingerprint(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components: no fixed point")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


def _fingerprint(links: DataFrame):
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
    ).first()
    return tuple(row)
