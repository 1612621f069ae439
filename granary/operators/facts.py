"""Fact table of daily prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import schemas as S
from granary.functions import stamped
from granary.operators.checks import require_all_unique
from granary.operators.lookups import lookup, lookup_as_of


def build_fact(
    silver: DataFrame,
    dim_date: DataFrame,
    dim_state: DataFrame,
    dim_market: DataFrame,
    dim_product: DataFrame,
    dim_variety: DataFrame,
    as_of: dt.datetime | str | None = None,
    validate: bool = True,
    keep: tuple[str, ...] = (),
    product_history: DataFrame | None = None,
) -> DataFrame:
    """One fact row per price row, with NULL for a dimension it does not match.

    The text of the date dimension is parsed once per day, so the join compares
    DATEs and the price rows are not formatted. `validate` checks that no
    dimension repeats a key, which would multiply fact rows. `keep` names further
    columns of the price rows to carry along, such as a partition column.

    With `product_history`, the type-2 history of the products, a price finds the product that had its name and group when
    it was loaded (NULL groups included), however often the product has moved since; `dim_product` is not read then.
    """
    by_day = dim_date.select(
        F.to_date("calendar_date", S.CALENDAR_DATE_FORMAT).alias("date_of_pricing"), "date_id"
    )
    lookups = [
        (by_day, ["date_of_pricing"], "date_id"),
        (dim_state, ["state_name"], "state_id"),
        (dim_market, ["market_name"], "market_id"),
        (dim_variety, ["variety"], "variety_id"),
    ]
    if product_history is None:
        lookups.append((dim_product, ["product_name", "productgroup_name"], "product_id"))
    fact = silver.select(
        "date_of_pricing", "state_name", "market_name", "product_name", "productgroup_name",
        "variety", "row_id", "arrival_in_tonnes", "maximum_price", "minimum_price", "modal_price",
        *keep, *(("source_file_load_date",) if product_history is not None else ()),
    )
    if validate:
        require_all_unique({f"repeated key behind {i}": (dim, keys) for dim, keys, i in lookups})
    for dim, keys, id_col in lookups:
        fact = lookup(fact, dim, keys, [id_col])
    if product_history is not None:
        fact = lookup_as_of(
            fact, product_history, ["product_name", "productgroup_name"], ["product_id"], "source_file_load_date",
            "effective_start_date", null_safe=("productgroup_name",),
        )
    return stamped(fact, as_of).select(*S.FACT_PRICING.fieldNames(), *keep)
