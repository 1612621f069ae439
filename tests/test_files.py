import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from granary.plans import reference_data
from granary import schemas as S
from granary.plans.reference_data import copy_reference_table
from granary.sinks import tables
from granary.sources.daily_csv import daily_files, read_daily_files
from granary.sources.fixtures import load_fixture
from granary.sources.jdbc import Slices, jdbc_options
from granary.sources.json_docs import read_json_lines
from granary.sources.tables import read_table
from granary.staging import scratch_path, scratch_root, stage
from granary.streaming.landing import land_available

COLUMNS = list(S.PRICING_COLUMNS)


def write_day(folder, day, columns=None, rows=2, extra="e"):
    folder.mkdir(exist_ok=True)
    columns = columns or COLUMNS
    text = [",".join(columns)]
    for i in range(rows):
        value = {c: f"{c}-{i}" for c in columns} | {"DATE_OF_PRICING": day.strftime("%m/%d/%Y"), "ROW_ID": str(i)}
        text.append(",".join(value[c] for c in columns))
    path = folder / f"PW_MW_DR_{day:%m%d%Y}.csv"
    path.write_text("\n".join(text) + "\n")
    return str(path)


D1, D2, D3 = dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 4)


def test_daily_files_are_found_by_name(spark, tmp_path):
    write_day(tmp_path, D1)
    write_day(tmp_path / "more", D3)
    (tmp_path / "notes.csv").write_text("x\n")
    (tmp_path / "PW_MW_DR_99992023.csv").write_text("x\n")
    assert sorted(r["file_date"] for r in daily_files(spark, str(tmp_path)).collect()) == [D1, D3]


def test_compressed_daily_files_are_read_like_plain_ones(spark, tmp_path):
    for path in (write_day(tmp_path, D1), write_day(tmp_path, D2)):
        with open(path, "rb") as plain, gzip.open(path + ".gz", "wb") as packed:
            packed.write(plain.read())
        os.remove(path)
    write_day(tmp_path, D3, [*reversed(COLUMNS)])
    found = {r["file_date"]: r["path"] for r in daily_files(spark, str(tmp_path)).collect()}
    assert sorted(found) == [D1, D2, D3]
    rows = read_daily_files(spark, list(found.values()), on_drift="align").collect()
    assert sorted((r["ROW_ID"], r["VARIETY"], r["file_date"]) for r in rows) == [(str(i), f"VARIETY-{i}", d) for i in range(2) for d in (D1, D2, D3)]
    os.remove(tmp_path / f"PW_MW_DR_{D3:%m%d%Y}.csv")
    land_available(spark, str(tmp_path), str(tmp_path / "sink"), str(tmp_path / "state")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "sink"))
    assert landed.count() == 4 and all(f.endswith(".zstd.parquet") for f in landed.inputFiles())


def test_tables_are_compressed_with_zstd(spark, tmp_path):
    name = "granary_files_zstd.days"
    rows = spark.range(40).selectExpr("id", "id % 2 day")
    tables.create_table(spark, name, rows.schema, str(tmp_path / "days"), ("day",))
    tables.replace_partitions(rows, name)
    tables.append_files(rows, str(tmp_path / "appended"))
    for written in (spark.table(name), spark.read.parquet(str(tmp_path / "appended"))):
        assert written.count() == 40 and all(f.endswith(".zstd.parquet") for f in written.inputFiles())


def test_expected_header_is_read_in_one_scan(spark, tmp_path):
    rows = read_daily_files(spark, [write_day(tmp_path, D1), write_day(tmp_path, D2)])
    assert rows.columns == [*COLUMNS, "file_date"]
    assert sorted((r["ROW_ID"], r["file_date"]) for r in rows.collect()) == [
        ("0", D1), ("0", D2), ("1", D1), ("1", D2),
    ]


def test_other_header_is_an_error_not_a_shift(spark, tmp_path):
    path = write_day(tmp_path, D1, list(reversed(COLUMNS)))
    with pytest.raises(Exception, match="(?i)header"):
        read_daily_files(spark, [path]).collect()
    with pytest.raises(ValueError):
        read_daily_files(spark, [path], on_drift="ignore")


def test_drifted_headers_are_aligned_by_name(spark, tmp_path):
    folder = tmp_path / "a folder"
    paths = [
        write_day(folder, D1),
        write_day(folder, D2, [*reversed(COLUMNS), "GRADE"]),
        write_day(folder, D3, [c for c in COLUMNS if c != "ORIGIN"]),
    ]
    rows = read_daily_files(spark, paths, on_drift="align")
    assert set(rows.columns) == {*COLUMNS, "file_date", "GRADE"}
    got = {r["file_date"]: r for r in rows.where("ROW_ID = '1'").collect()}
    assert [got[d]["MARKET_NAME"] for d in (D1, D2, D3)] == ["MARKET_NAME-1"] * 3
    assert [got[d]["ORIGIN"] for d in (D1, D2, D3)] == ["ORIGIN-1", "ORIGIN-1", None]
    assert [got[d]["GRADE"] for d in (D1, D2, D3)] == [None, "GRADE-1", None]


def test_header_with_mark_and_spaces(spark, tmp_path):
    path = write_day(tmp_path, D1, ["﻿DATE_OF_PRICING" if c == "DATE_OF_PRICING" else c for c in COLUMNS])
    rows = read_daily_files(spark, [path], on_drift="align").collect()
    assert len(rows) == 2 and rows[0]["ROW_ID"] in ("0", "1")


def test_stream_lands_each_file_once(spark, tmp_path):
    folder, sink, state = (tmp_path / n for n in ("in", "out", "state"))
    run = lambda: land_available(spark, str(folder), str(sink), str(state), files_per_batch=1).awaitTermination()
    counts = []
    write_day(folder, D1, rows=10)
    run()
    counts.append(spark.read.parquet(str(sink)).count())
    write_day(folder, D2, rows=5)
    for _ in range(2):
        run()
        counts.append(spark.read.parquet(str(sink)).count())
    assert counts == [10, 15, 15]
    rows = spark.read.parquet(str(sink))
    assert rows.where("source_file_load_date IS NULL OR file_date IS NULL").count() == 0


def test_append_allows_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_files(spark.sql("SELECT '1' AS a"), path)
    tables.append_files(spark.sql("SELECT '2' AS a, '3' AS b"), path)
    got = tables.read_evolving(spark, path)
    assert sorted(map(tuple, got.select("a", "b").collect())) == [("1", None), ("2", "3")]
    known = tables.read_evolving(spark, path, spark.sql("SELECT '' AS a").schema)
    assert known.columns == ["a"]


def test_json_folder_is_overwritten(spark, tmp_path):
    path = tables.sink_path(str(tmp_path) + "/", "masterdata.codes")
    assert path == f"{tmp_path}/masterdata/codes"
    for n in (3, 2):
        tables.overwrite_json(spark.range(n), path)
    assert read_json_lines(spark, path).count() == 2
    schema = spark.sql("SELECT 1L AS id, '' AS missing").schema
    assert read_json_lines(spark, path, schema).where("missing IS NULL").count() == 2
    tables.create_json_table(spark, "bronze_masterdata.codes", path)
    assert read_table(spark, "bronze_masterdata.codes", ("id",)).count() == 2


def test_append_is_by_name(spark, tmp_path):
    name = "sinks.dim_state"
    tables.create_table(spark, name, S.DIM_STATE, str(tmp_path / "t"))
    tables.create_table(spark, name, S.DIM_STATE, str(tmp_path / "t"))
    tables.append_table(spark.sql("SELECT 'x' AS STATE_NAME, 1 AS state_id"), name)
    row = spark.table(name).first()
    assert (row["state_id"], row["state_name"], row["created_at"]) == (1, "x", None)
    with pytest.raises(ValueError, match="surprise"):
        tables.append_table(spark.sql("SELECT 1 AS surprise"), name)


def test_publish_may_read_the_table_it_replaces(spark, tmp_path):
    name, root = "sinks.dim_market", str(tmp_path)
    tables.create_table(spark, name, S.DIM_MARKET, f"{root}/first")
    row = "SELECT 1L AS market_id, 'm' AS market_name"
    tables.append_table(spark.sql(row), name)
    for _ in range(2):
        old = spark.table(name)
        tables.publish(old.unionByName(old), name, root)
    assert spark.table(name).count() == 4
    before = spark.table(name)
    with pytest.raises(Exception):
        tables.publish(before.selectExpr("market_id", "raise_error('x') AS market_name"), name, root)
    assert spark.table(name).count() == 4


def test_replace_table_changes_the_schema(spark):
    tables.replace_table(spark.sql("SELECT 1 AS a"), "sinks.made")
    tables.replace_table(spark.sql("SELECT 1 AS b, 2 AS c"), "sinks.made")
    assert spark.table("sinks.made").columns == ["b", "c"]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    schema = spark.sql("SELECT 1L AS v, DATE'2024-01-01' AS day").schema
    tables.create_table(spark, "sinks.days", schema, str(tmp_path / "d"), ("day",))
    rows = lambda v, *days: spark.createDataFrame([(v, dt.date(2024, 1, d)) for d in days], schema)
    tables.replace_partitions(rows(1, 1, 2), "sinks.days", ("day",))
    tables.replace_partitions(rows(2, 2, 3), "sinks.days", ("day",))
    got = sorted((r["day"].day, r["v"]) for r in spark.table("sinks.days").collect())
    assert got == [(1, 1), (2, 2), (3, 2)]


def test_reference_copy_counts_and_keeps_types(spark, tmp_path):
    src = spark.sql("SELECT id, CAST(id AS DECIMAL(9,3)) AS d, DATE'2024-01-01' AS t FROM range(5)")
    copied = copy_reference_table(src, str(tmp_path), "masterdata.codes")
    assert (copied.rows, copied.path) == (5, f"{tmp_path}/masterdata/codes")
    assert [f.dataType for f in spark.read.parquet(copied.path).schema] == [f.dataType for f in src.schema]
    as_json = copy_reference_table(src, str(tmp_path), "masterdata.lines", "json")
    assert spark.read.json(as_json.path).count() == as_json.rows == 5


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "s.t", {"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "s.t", "fetchsize": "10000", "user": "u"}
    cut = jdbc_options("jdbc:x", "s.t", slices=Slices("id", 1, 100, 8))
    assert (cut["partitionColumn"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ("id", "1", "100", "8")


def test_fixture_loader(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    assert load_fixture(spark, str(tmp_path / "a.json")).count() == 2
    assert load_fixture(spark, str(tmp_path / "a.csv")).dtypes == [("a", "string"), ("b", "string")]
    with pytest.raises(ValueError, match="Unsupported"):
        load_fixture(spark, "a.xml")


def test_staged_tables_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_path(spark, "x").startswith(f"{root}/granary/")
    staged = stage(spark.range(7))
    assert staged.count() == 7
    assert all(f.startswith(f"file:{root}") or root in f for f in staged.inputFiles())


def test_staged_tables_are_compressed_with_zstd(spark):
    staged = stage(spark.range(7))
    assert staged.inputFiles() and all(f.endswith(".zstd.parquet") for f in staged.inputFiles())



def test_reference_tables_are_copied_one_by_one(spark, tmp_path, monkeypatch):
    asked = []

    def read(spark, url, table, properties, slices):
        asked.append((url, table, slices))
        return spark.range(len(asked)).withColumnRenamed("id", "code")

    monkeypatch.setattr(reference_data, "read_jdbc_table", read)
    copied = reference_data.copy_reference_data(spark, "jdbc:x", str(tmp_path), {}, ("a.b", "a.c"), {"a.c": "slices"})
    assert asked == [("jdbc:x", "a.b", None), ("jdbc:x", "a.c", "slices")]
    assert [(c.table, c.rows, spark.read.parquet(c.path).count()) for c in copied] == [("a.b", 1, 1), ("a.c", 2, 2)]


def test_partitions_are_replaced_by_the_values_their_folders_spell(spark, tmp_path):
    name = "parts_test.spelled"
    rows = [(1, "01", 5), (2, "1", 5), (3, "a b/'c", 6), (4, None, 6)]
    schema = StructType([StructField("v", LongType()), StructField("code", StringType()), StructField("n", LongType())])
    tables.create_table(spark, name, schema, str(tmp_path / "spelled"), ("code", "n"))
    try:
        tables.replace_partitions(spark.createDataFrame(rows, schema), name)
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(rows)
        tables.replace_partitions(spark.table(name).where("code = '01' or code is null").selectExpr("v * 10 AS v", "code", "n"), name)
        tables.replace_partitions(spark.createDataFrame([], schema), name)
        assert sorted(map(tuple, spark.table(name).collect())) == sorted([(10, "01", 5), (2, "1", 5), (3, "a b/'c", 6), (40, None, 6)])
    finally:
        spark.sql(f"DROP TABLE {name}")
