"""Single-column dimensions and the date dimension."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from granary.functions import calendar_text, stamped
from granary.operators.ids import dense_ids, highest_id
from granary.staging import empty_table


def new_members(src: DataFrame, dim: DataFrame, src_col: str, name_col: str) -> DataFrame:
    """Distinct non-NULL values of `src_col` that `dim` does not hold yet."""
    values = src.where(F.col(src_col).isNotNull()).select(F.col(src_col).alias(name_col)).distinct()
    return values.join(dim.select(name_col), name_col, "left_anti")


def new_dim_rows(
    src: DataFrame,
    dim: DataFrame,
    src_col: str,
    id_col: str,
    name_col: str,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """Rows to append to `dim`: new members, ids running on from its highest id."""
    members = new_members(src, dim, src_col, name_col)
    numbered = dense_ids(members, [name_col], id_col, highest_id(dim, id_col))
    return stamped(numbered, as_of)


def load_dim(
    src: DataFrame,
    dim: DataFrame,
    src_col: str,
    id_col: str,
    name_col: str,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """`dim` with the new members of `src` added. A second run adds nothing."""
    return dim.unionByName(new_dim_rows(src, dim, src_col, id_col, name_col, as_of))


def members(src: DataFrame, columns: dict[str, tuple[str, ...]]) -> DataFrame:
    """Distinct members of several dimensions in one pass: (dimension, member, within, load).

    `columns` gives for each dimension its member column and, where there are, a second column and a load column. Rows
    without a member are left out.
    """
    none = F.lit(None)
    cells = []
    for dimension, (member, *more) in columns.items():
        within, load = [F.col(c) for c in more] + [none] * (2 - len(more))
        cells.append(F.struct(
            F.lit(dimension).alias("dimension"), F.col(member).cast("string").alias("member"),
            within.cast("string").alias("within"), load.cast("long").alias("load"),
        ))
    return src.select(F.inline(F.array(*cells))).where("member is not null").distinct()


def new_ids(found: DataFrame, held: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Members that their dimension lacks, with ids running on from its highest: (dimension, member, id).

    `held` gives for each dimension its table, id and name column. All dimensions are numbered at once: positions in the order of
    (dimension, member), shifted per dimension. The driver sees one row per dimension.
    """
    known = reduce(
        DataFrame.unionByName,
        [t.select(F.lit(d).alias("dimension"), F.col(name).alias("member"), F.col(i).alias("_id")) for d, (t, i, name) in held.items()],
    )
    mine = found.where(F.col("dimension").isin(list(held))).select("dimension", "member")
    numbered = dense_ids(mine.join(known, ["dimension", "member"], "left_anti"), ["dimension", "member"], "_n")
    first = numbered.groupBy("dimension").agg((F.min("_n") - 1).alias("_shift"))
    tops = known.groupBy("dimension").agg(F.max("_id").alias("_top"))
    shift = {r["dimension"]: (r["_top"] or 0) - r["_shift"] for r in first.join(tops, "dimension", "left").collect()}
    if not shift:
        return empty_table(mine.sparkSession, StructType([*mine.schema.fields, StructField("id", LongType())]))
    by_dimension = F.create_map(*[F.lit(x) for pair in shift.items() for x in pair])
    return numbered.select("dimension", "member", (F.col("_n") + by_dimension[F.col("dimension")]).cast("long").alias("id"))


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day from the one-row frame `bounds`, with its 1-based position.

    The position in the generated sequence is the chronological row number, so no
    global sort or window is needed.
    """
    days = F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))
    return bounds.select(F.posexplode(days).alias("_pos", "calendar_day")).select(
        (F.col("_pos") + 1).cast("bigint").alias("date_id"), "calendar_day"
    )


def date_dim_between(
    bounds: DataFrame, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """Date dimension over the days of the one-row frame `bounds`."""
    return date_spine(bounds, start, end).select(
        "date_id", calendar_text("calendar_day").alias("calendar_date")
    )


def date_dim(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Date dimension from `start` to `end`, both included."""
    day = lambda d: F.lit(str(d)).cast("date")
    bounds = spark.range(1).select(day(start).alias("start_date"), day(end).alias("end_date"))
    return date_dim_between(bounds)
