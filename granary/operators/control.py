"""Run log and batch watermarks.

A watermark is one value, so it is resolved before the scan it filters: as a
literal it reaches the Parquet reader and prunes row groups, which a subquery
would not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import load_time


def completed_runs(log: DataFrame, process: str) -> DataFrame:
    return log.where(
        (F.col("process_name") == process) & (F.col("process_status") == S.STATUS_COMPLETED)
    )


def next_file_date(log: DataFrame, process: str, first: str = S.FIRST_FILE_DATE) -> DataFrame:
    """One row: the day after the last completed file, or `first`."""
    latest = F.max("processed_file_table_date").cast("date")
    return completed_runs(log, process).agg(
        F.coalesce(F.date_add(latest, 1), F.lit(first).cast("date")).alias("next_file_date")
    )


def watermark(
    log: DataFrame, process: str, precision: str = "timestamp", first: str = S.FIRST_LOAD_STAMP
) -> DataFrame:
    """One row: the highest load stamp a completed run has covered, or `first`.

    With precision "date" the stamp is cut to its day, so the next run reads that
    whole day again; "timestamp" reads each row once.
    """
    day = F.col("processed_file_table_date").cast("timestamp")
    stamp = F.coalesce(F.col("watermark_ts"), day) if precision == "timestamp" else day
    return completed_runs(log, process).agg(
        F.coalesce(F.max(stamp), F.lit(first).cast("timestamp")).alias("watermark")
    )


def load_batch(column: str = "source_file_load_date") -> Column:
    """Key of a load, for partitioning: its stamp in microseconds, free of time zones."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def incremental_rows(
    src: DataFrame,
    log: DataFrame,
    process: str,
    precision: str = "timestamp",
    column: str = "source_file_load_date",
    batch_column: str | None = None,
) -> DataFrame:
    """Rows of `src` loaded after the watermark of `process`.

    Rows without a load stamp never qualify; `unstamped_rows` lists them. The constant takes the type of the
    column, so the comparison can be pushed to the files. `batch_column` names a
    partition column holding `load_batch`; with it older partitions are not even
    listed.
    """
    top = watermark(log, process, precision).select(F.unix_micros("watermark").alias("us")).first()
    if batch_column:
        return src.where(F.col(batch_column) > F.lit(top["us"]))
    stamp = F.timestamp_micros(F.lit(top["us"])).cast(src.schema[column].dataType)
    return src.where(F.col(column) > stamp)


def unstamped_rows(src: DataFrame, column: str = "source_file_load_date") -> DataFrame:
    """Rows that no watermark ever takes, as they have no load stamp: the side output of `incremental_rows`."""
    return src.where(F.col(column).isNull())


def with_counts(
    entry: DataFrame, read: int | None = None, written: int | None = None, rejected: int | None = None
) -> DataFrame:
    """A run-log row with what its step has counted."""
    counts = {"rows_read": read, "rows_written": written, "rows_rejected": rejected}
    return entry.withColumns({name: F.lit(n).cast("long") for name, n in counts.items()})


def open_batches(log: DataFrame, landing: str, process: str, after: str | None = None) -> list[int]:
    """Load batches that `process` has yet to take, from the run log alone.

    These are the completed runs of `landing` which the step before, `after`, has
    covered and `process` has not. A batch without a completed run is left out, so
    what a crashed landing may have written is never read. The list has one number
    per landing run since the last run of `process`.
    """
    micros = F.unix_micros("watermark").alias("us")
    done = watermark(log, process).select(micros).first()["us"]
    ready = watermark(log, after or landing).select(micros).first()["us"]
    stamps = completed_runs(log, landing).select(F.unix_micros("watermark_ts").alias("us"))
    rows = stamps.where((F.col("us") > done) & (F.col("us") <= ready)).distinct().collect()
    return sorted(row["us"] for row in rows)


def covered(spark: SparkSession, process: str, batch: int, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Completed row of a run that took all batches up to `batch`."""
    stamp = F.timestamp_micros(F.lit(batch))
    return run_entry(spark, process, stamp.cast("date"), S.STATUS_COMPLETED, as_of, stamp)


def run_entry(
    spark: SparkSession,
    process: str,
    date: dt.date | Column | None,
    status: str,
    as_of: dt.datetime | str | None = None,
    watermark_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """One run-log row."""
    return spark.range(1).select(
        F.lit(process).alias("process_name"),
        F.lit(date).cast("date").alias("processed_file_table_date"),
        F.lit(status).alias("process_status"),
        load_time(as_of).alias("run_timestamp"),
        F.lit(watermark_ts).cast("timestamp").alias("watermark_ts"),
    )


def run_entries(
    dates: DataFrame,
    process: str,
    status: str,
    as_of: dt.datetime | str | None = None,
    watermark_ts: Column | None = None,
) -> DataFrame:
    """A run-log row for each date of a one-column frame."""
    return dates.select(
        F.lit(process).alias("process_name"),
        F.col(dates.columns[0]).alias("processed_file_table_date"),
        F.lit(status).alias("process_status"),
        load_time(as_of).alias("run_timestamp"),
        F.lit(watermark_ts).cast("timestamp").alias("watermark_ts"),
    )


def batch_entry(
    batch: DataFrame,
    process: str,
    as_of: dt.datetime | str | None = None,
    column: str = "source_file_load_date",
) -> DataFrame:
    """Completed row for a loaded batch: its highest load stamp. No row for an empty batch."""
    top = batch.agg(F.max(column).cast("timestamp").alias("watermark_ts"))
    return top.where(F.col("watermark_ts").isNotNull()).select(
        F.lit(process).alias("process_name"),
        F.col("watermark_ts").cast("date").alias("processed_file_table_date"),
        F.lit(S.STATUS_COMPLETED).alias("process_status"),
        load_time(as_of).alias("run_timestamp"),
        "watermark_ts",
    )


@contextmanager
def logged_run(
    spark: SparkSession,
    process: str,
    append: Callable[[DataFrame], None],
    date: dt.date | None = None,
    as_of: dt.datetime | str | None = None,
) -> Iterator[Callable[[DataFrame | None], None]]:
    """Log the body as Completed, or as Failed and raise its error again.

    `append` writes log rows. The body may call the yielded function with the
    log rows of its batch (or None for nothing to log) instead of the plain one.
    """
    day = date or dt.date.today()
    own: list[DataFrame | None] = []
    try:
        yield own.append
    except Exception:
        append(run_entry(spark, process, day, S.STATUS_FAILED, as_of))
        raise
    for entry in own or [run_entry(spark, process, day, S.STATUS_COMPLETED, as_of)]:
        if entry is not None:
            append(entry)
