"""Landing of price files as a stream that stops when it has caught up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary import schemas as S
from granary.functions import file_date
from granary.sinks.tables import CODEC
from granary.sources.daily_csv import FILE_NAMES, stamp_landing


def stream_daily_files(
    spark: SparkSession, folder: str, files_per_batch: int | None = None,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """New price files below `folder` as a stream of text rows with date and load stamp.

    A file with another header fails the batch instead of shifting its values;
    land such files with `read_daily_files(…, on_drift="align")`.
    """
    reader = (
        spark.readStream.schema(S.RAW_PRICING)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILE_NAMES)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(folder).select("*", file_date("_metadata.file_path").alias("file_date"))
    return stamp_landing(rows.where(F.col("file_date").isNotNull()), as_of)


def land_available(
    spark: SparkSession, folder: str, sink: str, checkpoint: str,
    files_per_batch: int | None = None, as_of: dt.datetime | str | None = None,
) -> StreamingQuery:
    """Append every file not landed before to the Parquet folder `sink`, then stop.

    The checkpoint remembers the files and the sink its committed batches, so a
    run that is repeated or killed half way lands each file exactly once.
    """
    return (
        stream_daily_files(spark, folder, files_per_batch, as_of)
        .writeStream.format("parquet")
        .option("compression", CODEC)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
