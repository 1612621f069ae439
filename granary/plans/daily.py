"""The daily price load: landing, cleaning, dimensions, facts.

A landing run is a batch, known by its load stamp. It counts from the moment the
run log calls it completed. Every later step takes the batches that the step
before has completed and it has not, and replaces whatever it wrote for them
before. So a step can be repeated after a crash at any point, and the log, not
the data, is read to find out what is new.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import load_time, stamped
from granary.operators import cleaning, control, dimensions, facts, history, merging
from granary.plans import lakehouse as names
from granary.operators.ids import highest_id
from granary.plans.lakehouse import BUCKET, CLOSED_BY, LOAD_BATCH, Lakehouse, bucket
from granary.sources.daily_csv import daily_files, read_daily_files
from granary.staging import stage, stage_counted

AsOf = dt.datetime | str | None


def new_files(lake: Lakehouse, folder: str) -> DataFrame:
    """Files whose date no completed landing has taken, from the first file date on.

    A day without a file blocks nothing, and a file that arrives late is taken then.
    """
    landed = control.completed_runs(lake.table(names.RUN_LOG), S.PROCESS_INGEST).select(
        F.col("processed_file_table_date").alias("file_date")
    )
    files = daily_files(lake.spark, folder).where(F.col("file_date") >= F.lit(S.FIRST_FILE_DATE).cast("date"))
    return files.join(landed, "file_date", "left_anti")


def _new_batch(lake: Lakehouse, as_of: AsOf) -> int:
    """Key of the next batch: the load time, which must move on from batch to batch."""
    log = lake.table(names.RUN_LOG)
    now = F.unix_micros(load_time(as_of)).alias("now")
    last = F.unix_micros("watermark").alias("last")
    row = control.watermark(log, S.PROCESS_INGEST).select(now, last).first()
    if row["now"] <= row["last"]:
        raise ValueError("the load time is not after that of the last completed landing")
    return row["now"]


def ingest_prices(
    lake: Lakehouse, folder: str, as_of: AsOf = None, on_drift: str = "align"
) -> int:
    """Land all new files of `folder` as one batch; returns how many there were.

    The log gets a row for each file date. One row per new file comes to the driver: on a
    first load those of the whole backlog, else about one a day.
    """
    files = new_files(lake, folder).select("path", "file_date").collect()
    if not files:
        return 0
    last = max(row["file_date"] for row in files)
    with control.logged_run(lake.spark, S.PROCESS_INGEST, lake.log, last, as_of) as done:
        batch = _new_batch(lake, as_of)
        stamp = F.timestamp_micros(F.lit(batch))
        rows = read_daily_files(lake.spark, sorted(row["path"] for row in files), on_drift)
        landed = rows.withColumns({"source_file_load_date": stamp, LOAD_BATCH: F.lit(batch)})
        lake.add_columns(names.BRONZE, landed)
        lake.replace_batches(landed, names.BRONZE)
        # Counted from the footers of the files written, not row by row for each date; a file without rows has no partition.
        counted = lake.batches(names.BRONZE, [batch]).groupBy("file_date").count().collect()
        found = {d: 0 for d in (r["file_date"] for r in files)} | {r["file_date"]: r["count"] for r in counted}
        dates = lake.spark.createDataFrame(sorted(found.items()), "day date, rows long")
        entries = control.run_entries(dates.select("day"), S.PROCESS_INGEST, S.STATUS_COMPLETED, as_of, stamp)
        done(entries.join(dates.withColumnRenamed("day", "processed_file_table_date"), "processed_file_table_date").withColumns(
            {"rows_read": F.col("rows"), "rows_written": F.col("rows")}
        ).drop("rows"))
    return len(files)


def _open(lake: Lakehouse, process: str, after: str) -> list[int]:
    return control.open_batches(lake.table(names.RUN_LOG), S.PROCESS_INGEST, process, after)


def load_silver(lake: Lakehouse, as_of: AsOf = None) -> None:
    """Type the landed rows of the open batches; rows with a value that does not parse also go to the rejects."""
    with control.logged_run(lake.spark, S.PROCESS_SILVER, lake.log, as_of=as_of) as done:
        batches = _open(lake, S.PROCESS_SILVER, S.PROCESS_INGEST)
        if not batches:
            return done(None)
        read, rejected = type_batches(lake, batches, as_of)
        entry = control.covered(lake.spark, S.PROCESS_SILVER, batches[-1], as_of)
        done(control.with_counts(entry, read, read, rejected))


def type_batches(lake: Lakehouse, batches: list[int], as_of: AsOf = None) -> tuple[int, int]:
    """Silver rows and rejects of some landed batches, in one pass; rows read and rows rejected."""
    seen = Observation()
    landed = lake.batches(names.BRONZE, batches)
    lake.write_outcomes(cleaning.split_outcomes(landed, as_of, (LOAD_BATCH,), seen))
    return seen.get["rows_read"], seen.get["rows_rejected"]


_SINGLE = {"state": (names.DIM_STATE, "state_name"), "market": (names.DIM_MARKET, "market_name"), "variety": (names.DIM_VARIETY, "variety")}


def load_dimensions(lake: Lakehouse, as_of: AsOf = None) -> None:
    """Bring state, market, variety, product and product history up to date.

    Members of earlier batches are in the dimensions already, so only open batches
    are read, once for all dimensions. Products are kept by name and group, as the facts look them up, and are merged as
    if each open batch had come alone; versions of the history start at the stamp of their batch.
    """
    with control.logged_run(lake.spark, S.PROCESS_DIMENSIONS, lake.log, as_of=as_of) as done:
        batches = _open(lake, S.PROCESS_DIMENSIONS, S.PROCESS_SILVER)
        if not batches:
            return done(None)
        read, added = extend_dimensions(lake, batches, as_of)
        entry = control.covered(lake.spark, S.PROCESS_DIMENSIONS, batches[-1], as_of)
        done(control.with_counts(entry, read, added))


def extend_dimensions(lake: Lakehouse, batches: list[int], as_of: AsOf = None) -> tuple[int, int]:
    """All dimensions with the members of some silver batches, which are scanned once; members read and changes made."""
    wanted = {d: (column,) for d, (_, column) in _SINGLE.items()}
    wanted["product"] = ("product_name", "productgroup_name", "_load")
    rows = lake.batches(names.SILVER, batches).withColumn("_load", F.coalesce(control.load_batch(), LOAD_BATCH))
    found, n_members = stage_counted(dimensions.members(rows, wanted), "members")
    return n_members, _load_single(lake, found, as_of) + _load_products(lake, found, as_of)


def _load_single(lake: Lakehouse, found: DataFrame, as_of: AsOf) -> int:
    """State, market and variety with their new members; how many there are. A dimension without any is left alone."""
    held = {}
    for dimension, (table, _) in _SINGLE.items():
        id_col, name_col = names.SCHEMAS[table].fieldNames()[:2]
        held[dimension] = (lake.table(table), id_col, name_col)
    fresh = stage(dimensions.new_ids(found, held), "fresh")
    counts = {r["dimension"]: r["count"] for r in fresh.groupBy("dimension").count().collect()}
    for dimension in counts:
        dim, id_col, name_col = held[dimension]
        rows = fresh.where(F.col("dimension") == dimension).select(F.col("id").alias(id_col), F.col("member").alias(name_col))
        lake.publish(dim.unionByName(stamped(rows, as_of)), _SINGLE[dimension][0])
    return sum(counts.values())


def _touched(changes: DataFrame, column: str) -> list[int]:
    return sorted(r[0] for r in changes.select(bucket(column)).distinct().collect())


def _load_products(lake: Lakehouse, found: DataFrame, as_of: AsOf) -> int:
    """Product history and product dimension, of each only the buckets that change; how many changes there are.

    The history goes first: should the run end between the two, its repetition finds the history ahead, gives new products
    the ids they have there, and passes over loads that are in it.
    """
    pairs = found.where("dimension = 'product'").select(
        F.col("member").alias("product_name"), F.col("within").alias("productgroup_name"), F.timestamp_micros("load").alias("loaded")
    )
    products, versions = lake.table(names.DIM_PRODUCT), lake.table(names.DIM_PRODUCT_SCD2)
    changes, n_changes = stage_counted(merging.product_changes_by_load(pairs, products, "loaded", versions), "changes")
    if not n_changes:
        return 0
    current = versions.where((F.col(CLOSED_BY) == 0) & F.col(BUCKET).isin(_touched(changes, "product_id")))
    added = history.new_versions(
        changes.drop("is_new"), current, "loaded", first_sk=highest_id(versions, "product_sk")
    )
    after = history.with_versions(current.select(*S.DIM_PRODUCT_SCD2.fieldNames()), added, as_of=as_of)
    closed_by = F.when(F.col("is_current"), 0).otherwise(F.unix_micros("effective_end_date"))
    lake.replace_batches(after.withColumns({CLOSED_BY: closed_by, BUCKET: bucket("product_id")}), names.DIM_PRODUCT_SCD2)
    touched = products.where(F.col(BUCKET).isin(_touched(changes, "product_name")))
    merged = merging.apply_product_changes(touched, changes, as_of, "loaded")
    lake.replace_batches(merged.withColumn(BUCKET, bucket("product_name")), names.DIM_PRODUCT)
    return n_changes


def load_date_dim(lake: Lakehouse, start: dt.date | str, end: dt.date | str) -> None:
    """Rebuild the date dimension for the days from `start` to `end`."""
    lake.publish(dimensions.date_dim(lake.spark, start, end), names.DIM_DATE)


def load_facts(lake: Lakehouse, as_of: AsOf = None) -> None:
    """Facts of the open batches.

    Products are looked up in the history as of the row's load, so a row finds its product also when that has moved on
    since, whatever steps were left out in between. Earlier facts keep the keys they were given.
    """
    with control.logged_run(lake.spark, S.PROCESS_FACT, lake.log, as_of=as_of) as done:
        batches = _open(lake, S.PROCESS_FACT, S.PROCESS_DIMENSIONS)
        if not batches:
            return done(None)
        n = write_facts(lake, batches, as_of)
        done(control.with_counts(control.covered(lake.spark, S.PROCESS_FACT, batches[-1], as_of), n, n))


def write_facts(lake: Lakehouse, batches: list[int], as_of: AsOf = None) -> int:
    """Facts of some silver batches, and how many there are."""
    seen = Observation()
    fact = facts.build_fact(
        lake.batches(names.SILVER, batches).observe(seen, F.count(F.lit(1)).alias("rows")),
        lake.table(names.DIM_DATE),
        lake.table(names.DIM_STATE),
        lake.table(names.DIM_MARKET),
        lake.table(names.DIM_PRODUCT),
        lake.table(names.DIM_VARIETY),
        as_of,
        keep=(LOAD_BATCH,),
        product_history=lake.table(names.DIM_PRODUCT_SCD2),
    )
    lake.replace_batches(fact, names.FACT)
    return seen.get["rows"]


def run_daily(
    lake: Lakehouse, folder: str, start: dt.date | str, end: dt.date | str, as_of: AsOf = None
) -> int:
    """The whole daily load in order; `start` and `end` bound the date dimension."""
    lake.create()
    count = ingest_prices(lake, folder, as_of)
    load_silver(lake, as_of)
    load_date_dim(lake, start, end)
    load_dimensions(lake, as_of)
    load_facts(lake, as_of)
    return count
