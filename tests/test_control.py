import datetime as dt

import pytest

from granary import schemas as S
from granary.operators import control

P = "load"
DAY = dt.date(2024, 1, 5)
NOON = dt.datetime(2024, 1, 5, 12, 0, 0, 123456)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), S.RUN_LOG)


def src(spark, *stamps):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(stamps)], "id int, source_file_load_date timestamp"
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_next_file_date(spark):
    first = control.next_file_date(log(spark), P).first()
    assert first["next_file_date"] == dt.date(2023, 1, 1)
    runs = log(
        spark,
        (P, DAY, "Completed", None, None),
        (P, dt.date(2024, 1, 9), "Failed", None, None),
        ("other", dt.date(2024, 1, 8), "Completed", None, None),
    )
    assert control.next_file_date(runs, P).first()["next_file_date"] == dt.date(2024, 1, 6)


def test_incremental_rows_without_a_run_reads_all_but_null_stamps(spark):
    rows = src(spark, NOON, None, dt.datetime(1899, 1, 1))
    assert ids(control.incremental_rows(rows, log(spark), P)) == [0]


def test_timestamp_watermark_reads_each_row_once(spark):
    rows = src(
        spark, NOON - dt.timedelta(microseconds=1), NOON, NOON + dt.timedelta(microseconds=1)
    )
    runs = log(spark, (P, DAY, "Completed", None, NOON))
    assert ids(control.incremental_rows(rows, runs, P)) == [2]
    assert ids(control.incremental_rows(rows, runs, P, "date")) == [0, 1, 2]


def test_watermark_falls_back_to_the_date(spark):
    runs = log(spark, (P, DAY, "Completed", None, None))
    rows = src(spark, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 0, 0, 1))
    assert ids(control.incremental_rows(rows, runs, P)) == [1]


def test_batch_column_selects_the_same_rows(spark):
    rows = src(spark, NOON, NOON + dt.timedelta(microseconds=1), NOON + dt.timedelta(days=1), None)
    rows = rows.withColumn("batch", control.load_batch())
    runs = log(spark, (P, DAY, "Completed", None, NOON))
    assert ids(control.incremental_rows(rows, runs, P, batch_column="batch")) == [1, 2]
    assert ids(control.incremental_rows(rows, log(spark), P, batch_column="batch")) == [0, 1, 2]


def test_batch_entry_is_the_maximum_of_the_batch(spark):
    entry = control.batch_entry(src(spark, NOON, None), P, "2024-02-01 00:00:00").first()
    assert entry["watermark_ts"] == NOON
    assert entry["processed_file_table_date"] == DAY
    assert entry["run_timestamp"] == dt.datetime(2024, 2, 1)
    assert control.batch_entry(src(spark), P).count() == 0


def test_rerun_after_logging_finds_nothing(spark):
    rows = src(spark, NOON, NOON - dt.timedelta(hours=1))
    runs = log(spark).unionByName(control.batch_entry(rows, P))
    assert control.incremental_rows(rows, runs, P).count() == 0


def test_logged_run(spark):
    written = []
    append = lambda df: written.extend(df.collect())
    with control.logged_run(spark, P, append, DAY):
        pass
    with pytest.raises(KeyError), control.logged_run(spark, P, append, DAY):
        raise KeyError("x")
    with control.logged_run(spark, P, append, DAY) as done:
        done(control.run_entry(spark, P, DAY, "Completed", watermark_ts=NOON))
    assert [(r["process_status"], r["watermark_ts"]) for r in written] == [
        ("Completed", None), ("Failed", None), ("Completed", NOON),
    ]
    assert all(r["run_timestamp"] is not None for r in written)
