"""Text to typed values and back. Bad input gives NULL, never a failed job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from granary import schemas as S


def pricing_date(text: Column | str) -> Column:
    """DATE from `MM/dd/yyyy` text.

    The parser throws and catches an exception for text it rejects, so text
    without the two separators in their places is not even given to it.
    """
    slashes = F.concat(F.substring(text, 3, 1), F.substring(text, 6, 1)) == "//"
    return F.when(slashes, F.try_to_date(text, S.PRICING_DATE_FORMAT))


def to_id(text: Column | str) -> Column:
    return F.col(text).try_cast("bigint") if isinstance(text, str) else text.try_cast("bigint")


def to_amount(text: Column | str, dtype: DecimalType) -> Column:
    """Decimal rounded half up to the scale of `dtype`."""
    return F.col(text).try_cast(dtype) if isinstance(text, str) else text.try_cast(dtype)


def calendar_text(date: Column | str) -> Column:
    """The `dd/MM/yyyy` text the date dimension is keyed by."""
    return F.date_format(date, S.CALENDAR_DATE_FORMAT)


def daily_file_name(date: dt.date | str) -> str:
    """Name of the price file of one day."""
    day = dt.date.fromisoformat(str(date))
    return f"{S.DAILY_FILE_PREFIX}{day:%m%d%Y}.csv"


def price_file(date: Column | str) -> Column:
    """`daily_file_name` of each row's date."""
    return F.concat(F.lit(S.DAILY_FILE_PREFIX), F.date_format(date, S.DAILY_FILE_DATE_FORMAT), F.lit(".csv"))


def file_date(path: Column | str) -> Column:
    """DATE in the name of a price file; NULL for any other path."""
    digits = F.regexp_extract(path, S.DAILY_FILE_PATTERN, 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), S.DAILY_FILE_DATE_FORMAT)


def table_folder(table: str) -> str:
    """Relative folder of a dotted table name."""
    return table.replace(".", "/")


def json_line(*columns: Column | str) -> Column:
    """One JSON text line per row."""
    return F.to_json(F.struct(*(columns or ("*",))))
