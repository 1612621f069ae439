"""Daily price files: one CSV per day with the date in its name, plain or compressed with gzip (`.csv.gz`)."""

from __future__ import annotations

import csv
import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from granary import schemas as S
from granary.functions import file_date, load_time
from granary.staging import empty_table

HEADER_JOBS = 8

#: Names of price files below a folder.
FILE_NAMES = "*.csv{,.gz}"


def daily_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and date of every price file below `folder`; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILE_NAMES)
        .load(folder)
    )
    dated = files.select("path", "length", file_date("path").alias("file_date"))
    return dated.where(F.col("file_date").isNotNull())


def file_headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file, "" of an empty one.

    A small job per file reads the beginning of its first split and no more; several
    run side by side. There is about one new file a day.
    """

    def header(path: str) -> str:
        line = spark.read.text(path).first()
        return line["value"] if line else ""

    with ThreadPoolExecutor(HEADER_JOBS) as jobs:
        return dict(zip(paths, jobs.map(header, paths)))


def _text_columns(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


def _read(spark: SparkSession, paths: list[str], columns: StructType) -> DataFrame:
    # enforceSchema=false compares each file's header with `columns` and fails on
    # a difference; by default Spark would silently assign values by position.
    return (
        spark.read.schema(columns)
        .option("header", "true")
        .option("enforceSchema", "false")
        .csv(paths)
        .select("*", file_date("_metadata.file_path").alias("file_date"))
    )


def read_daily_files(spark: SparkSession, paths: list[str], on_drift: str = "error") -> DataFrame:
    """Text columns of price files plus `file_date`.

    on_drift="error": one scan; a file whose header is not the expected one fails
    the job. on_drift="align": the headers of these (new) files are read first,
    files with the same header are scanned together under it, and columns are
    matched by name; a missing column is NULL and an extra one is kept.
    """
    if on_drift == "error":
        return _read(spark, paths, S.RAW_PRICING)
    if on_drift != "align":
        raise ValueError(f"on_drift must be 'error' or 'align', not {on_drift!r}")

    by_header: dict[str, list[str]] = {}
    for path, header in file_headers(spark, [unquote(path) for path in paths]).items():
        if header:
            by_header.setdefault(header, []).append(path)
    groups = []
    for header, members in sorted(by_header.items()):
        names = next(csv.reader([header.removeprefix("﻿")]))
        frame = _read(spark, sorted(members), _text_columns(names))
        groups.append(frame.toDF(*(name.strip() for name in names), "file_date"))
    known = empty_table(spark, S.RAW_PRICING)
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), groups, known
    )


def stamp_landing(rows: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Rows with the time they were landed."""
    return rows.withColumn("source_file_load_date", load_time(as_of))
