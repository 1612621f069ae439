"""Column expressions shared by the operators."""

from granary.functions.audit import load_time, stamped
from granary.functions.parsing import (
    calendar_text,
    daily_file_name,
    file_date,
    json_line,
    price_file,
    pricing_date,
    table_folder,
    to_amount,
    to_id,
)

__all__ = [
    "calendar_text",
    "daily_file_name",
    "file_date",
    "json_line",
    "load_time",
    "price_file",
    "pricing_date",
    "stamped",
    "table_folder",
    "to_amount",
    "to_id",
]
