"""The daily load as micro-batches: each goes from file rows to facts before the next begins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.plans import daily
from granary.plans import lakehouse as names
from granary.plans.lakehouse import LOAD_BATCH, Lakehouse
from granary.streaming.landing import stream_daily_files

AsOf = dt.datetime | str | None


def load_micro_batch(lake: Lakehouse, rows: DataFrame, batch_id: int, as_of: AsOf = None) -> None:
    """Bronze, silver, rejects, dimensions and facts of one micro-batch.

    The batch id is the key of its partitions in all of these tables, so a batch that is repeated after a crash at any
    point replaces what it wrote before; dimensions take a repeated batch as nothing new.
    """
    landed = rows.withColumn(LOAD_BATCH, F.lit(batch_id).cast("long"))
    lake.add_columns(names.BRONZE, landed)
    lake.replace_batches(landed, names.BRONZE)
    daily.type_batches(lake, [batch_id], as_of)
    daily.extend_dimensions(lake, [batch_id], as_of)
    daily.write_facts(lake, [batch_id], as_of)


def run_available(
    lake: Lakehouse, folder: str, checkpoint: str, files_per_batch: int | None = None, as_of: AsOf = None
) -> StreamingQuery:
    """Load every price file not loaded before, `files_per_batch` at a time, then stop.

    The checkpoint gives a repeated batch the same files and id as before. A lake is fed either by this or by the daily
    steps, as both number their batches. The date dimension must be there.
    """
    return (
        stream_daily_files(lake.spark, folder, files_per_batch, as_of)
        .writeStream.foreachBatch(lambda rows, batch_id: load_micro_batch(lake, rows, batch_id, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
