"""Load-time stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_time(as_of: dt.datetime | str | None = None) -> Column:
    """The given load time, or the start time of the running query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def stamped(
    df: DataFrame,
    as_of: dt.datetime | str | None = None,
    columns: tuple[str, ...] = ("created_at", "updated_at"),
) -> DataFrame:
    """`df` with the load time in each of `columns`."""
    return df.withColumns({name: load_time(as_of) for name in columns})
