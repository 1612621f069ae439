"""Typed price rows from landed text."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import pricing_date, stamped, to_amount, to_id


def _typed() -> dict[str, Column]:
    return {
        "DATE_OF_PRICING": pricing_date("DATE_OF_PRICING"),
        "ROW_ID": to_id("ROW_ID"),
        "ARRIVAL_IN_TONNES": to_amount("ARRIVAL_IN_TONNES", S.TONNES),
        "MINIMUM_PRICE": to_amount("MINIMUM_PRICE", S.MONEY),
        "MAXIMUM_PRICE": to_amount("MAXIMUM_PRICE", S.MONEY),
        "MODAL_PRICE": to_amount("MODAL_PRICE", S.MONEY),
    }


def clean_daily_pricing(raw: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """One typed row per landed row; a value that does not parse becomes NULL.

    `raw` holds the text columns of a price file plus `source_file_load_date`.
    The plan is a single projection over the scan.
    """
    typed = _typed()
    columns = [typed.get(name, F.col(name)).alias(name.lower()) for name in S.PRICING_COLUMNS]
    return stamped(raw.select(*columns, "source_file_load_date"), as_of)


def _failed(raw: DataFrame) -> dict[str, Column]:
    failed = {
        name.lower(): F.col(name).isNotNull() & parsed.isNull()
        for name, parsed in _typed().items()
    }
    if "source_file_load_date" in raw.columns:
        failed["source_file_load_date"] = F.col("source_file_load_date").isNull()
    return failed


def split_outcomes(
    raw: DataFrame, as_of: dt.datetime | str | None = None, keep: tuple[str, ...] = (), seen: Observation | None = None
) -> DataFrame:
    """Typed rows and rejects in one pass over `raw`: a row per landed row with outcome "typed", as `clean_daily_pricing`
    gives it, and one with outcome "rejected" for each that `rejected_values` lists.

    Rejects carry `landed`, the text as it came, and `rejected_columns`; typed rows have NULL there. `keep` names columns to
    carry along. `seen` observes rows_read and rows_rejected while the result is written.
    """
    # Each value is parsed once: what failed is read off the typed columns, and the text is put together for rejects alone.
    typed = _typed()
    columns = [typed.get(name, F.col(name)).alias(name.lower()) for name in S.PRICING_COLUMNS]
    text = [F.col(c).alias(f"_text_{c}") for c in S.LANDED_PRICING.fieldNames()]
    rows = raw.select(*columns, "source_file_load_date", *text, *keep)
    failed = {name.lower(): F.col(f"_text_{name}").isNotNull() & F.col(name.lower()).isNull() for name in typed}
    failed["source_file_load_date"] = F.col("source_file_load_date").isNull()
    # Text without lambdas, which would keep the whole projection from being compiled.
    names = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in failed.items()])
    rows = stamped(rows.withColumn("_names", names), as_of)
    if seen is not None:
        bad = F.count_if(F.col("_names") != "")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows_read"), bad.alias("rows_rejected"))
    outcomes = F.when(F.col("_names") != "", F.array(F.lit("typed"), F.lit("rejected"))).otherwise(F.array(F.lit("typed")))
    rows = rows.withColumn("outcome", F.explode(outcomes))
    rejected = F.col("outcome") == "rejected"
    landed = F.struct(*[F.col(f"_text_{c}").alias(c) for c in S.LANDED_PRICING.fieldNames()])
    out = [c for c in rows.columns if not c.startswith("_text_") and c != "_names"]
    return rows.select(*out, F.when(rejected, landed).alias("landed"), F.when(rejected, F.split("_names", ",")).alias("rejected_columns"))


def rejected_values(raw: DataFrame) -> DataFrame:
    """Landed rows with a value that cleaning turned into NULL.

    `rejected_columns` names the offending columns; `source_file_load_date` is
    among them when it is missing, since such a row never passes a watermark.
    """
    failed = _failed(raw)
    names = [F.when(bad, F.lit(name)) for name, bad in failed.items()]
    rejected = raw.where(reduce(lambda a, b: a | b, failed.values()))
    return rejected.withColumn("rejected_columns", F.array_compact(F.array(*names)))
