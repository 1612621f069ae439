"""Intermediate tables in the folder all executors share.

A staged frame is written once and read back as Parquet. That cuts the lineage
with files that outlive any executor, keeps a frame that two consumers share from
being computed twice, and gives the optimizer the true size of the data, so its
broadcast threshold acts on measured bytes and no join needs a hint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`, or else one below the warehouse, which is shared too."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or overwritten."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/granary/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete the files of staged tables. Only for tables of which all that was computed from them is written itself."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if staged:
        drop_shuffles(staged[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more.

    It deletes them when the driver's garbage collection finds the plan gone, which with a large heap is long after its last use. The
    second collection finds what the first still held; the last plan may stay until the next call.
    """
    for _ in range(2):
        spark._jvm.System.gc()


def stage_counted(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """The written table and its number of rows, counted while writing."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return staged, seen.get["rows"]


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of `schema`, in a form the optimizer knows to be empty."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nothing).limit(0)
