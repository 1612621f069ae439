import datetime as dt
from decimal import Decimal

from granary import schemas as S
from pyspark.sql.types import LongType, StructField, StructType

from granary.sources.json_docs import land_responses
from granary.functions import (
    calendar_text,
    daily_file_name,
    file_date,
    json_line,
    table_folder,
)
from granary.operators.cleaning import clean_daily_pricing, rejected_values, split_outcomes
from pyspark.sql import functions as F

STAMP = dt.datetime(2024, 1, 5, 6, 7, 8, 901234)


def raw(spark, **values):
    row = {name: None for name in S.LANDED_PRICING.fieldNames()}
    row |= {
        "DATE_OF_PRICING": "01/13/2023", "ROW_ID": "7", "ARRIVAL_IN_TONNES": "1.5",
        "MINIMUM_PRICE": "2", "MAXIMUM_PRICE": "3", "MODAL_PRICE": "2.5",
        "source_file_load_date": STAMP,
    }
    row |= values
    return spark.createDataFrame([tuple(row[n] for n in S.LANDED_PRICING.fieldNames())], S.LANDED_PRICING)


def test_types_and_order_are_those_of_the_table(spark):
    typed = clean_daily_pricing(raw(spark))
    assert [(f.name, f.dataType) for f in typed.schema] == [
        (f.name, f.dataType) for f in S.SILVER_PRICING
    ]
    row = typed.first()
    assert row["date_of_pricing"] == dt.date(2023, 1, 13)
    assert row["row_id"] == 7
    assert row["arrival_in_tonnes"] == Decimal("1.50")
    assert row["source_file_load_date"] == STAMP


def test_amounts_round_half_up(spark):
    row = clean_daily_pricing(raw(spark, MODAL_PRICE="2.345", MINIMUM_PRICE="-2.345")).first()
    assert (row["modal_price"], row["minimum_price"]) == (Decimal("2.35"), Decimal("-2.35"))


def test_bad_values_become_null_and_are_reported(spark):
    for column, text in [
        ("DATE_OF_PRICING", "13/45/2023"),
        ("DATE_OF_PRICING", "1/3/2023"),
        ("DATE_OF_PRICING", "2023-01-13"),
        ("DATE_OF_PRICING", ""),
        ("ROW_ID", "x7"),
        ("ARRIVAL_IN_TONNES", ""),
        ("MODAL_PRICE", "1,5"),
        ("ARRIVAL_IN_TONNES", "1" * 17),
    ]:
        landed = raw(spark, **{column: text})
        assert clean_daily_pricing(landed).first()[column.lower()] is None
        rejects = rejected_values(landed).collect()
        assert [r["rejected_columns"] for r in rejects] == [[column.lower()]], (column, text)


def test_null_input_is_no_reject(spark):
    landed = raw(spark, DATE_OF_PRICING=None, MODAL_PRICE=None)
    assert clean_daily_pricing(landed).count() == 1
    assert rejected_values(landed).count() == 0


def test_missing_load_stamp_is_reported(spark):
    rejects = rejected_values(raw(spark, source_file_load_date=None, ROW_ID="?")).first()
    assert rejects["rejected_columns"] == ["row_id", "source_file_load_date"]


def test_load_time_can_be_given(spark):
    row = clean_daily_pricing(raw(spark), as_of="2024-02-03 04:05:06").first()
    assert row["created_at"] == row["updated_at"] == dt.datetime(2024, 2, 3, 4, 5, 6)


def test_text_helpers(spark):
    assert daily_file_name("2023-01-13") == "PW_MW_DR_01132023.csv"
    assert daily_file_name(dt.date(2023, 1, 13)) == "PW_MW_DR_01132023.csv"
    assert table_folder("masterdata.exchange_rates") == "masterdata/exchange_rates"
    paths = ["file:/x/PW_MW_DR_01132023.csv", "file:/x/PW_MW_DR_13012023.csv", "file:/x/other.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in df.select(file_date("path")).collect()] == [dt.date(2023, 1, 13), None, None]
    texts = ['{"a": 1}', "{}", '[{"a": 1}]', '"a"', "null", "{broken", "", None]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r[0] for r in land_responses(lines, StructType([StructField("a", LongType())])).collect()] == [1, None]
    one = spark.range(1).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    assert one.select(json_line()).first()[0] == '{"a":1,"b":"x"}'
    assert one.select(calendar_text(F.lit(dt.date(2023, 12, 1)))).first()[0] == "01/12/2023"


def test_split_outcomes_lists_rejects_without_lambdas(spark):
    text = ["01/02/2023", "7", "S", "M", "G", "P", "V", "O", "1.005", "2", None, "x"]
    raw = spark.createDataFrame([(*text, None)], S.LANDED_PRICING)
    rows = split_outcomes(raw.union(raw.selectExpr(*[
        f"'{v}' AS {c}" for c, v in zip(S.RAW_PRICING.fieldNames(), ["13/45/2023", "8", "S", "M", "G", "P", "V", "O", "a", "b", "c", "4"])
    ], "timestamp'2024-01-01' AS source_file_load_date")))
    got = {(r["row_id"], r["outcome"]): r for r in rows.collect()}
    assert sorted(got) == [(7, "rejected"), (7, "typed"), (8, "rejected"), (8, "typed")]
    assert got[7, "rejected"]["rejected_columns"] == ["modal_price", "source_file_load_date"]
    assert got[8, "rejected"]["rejected_columns"] == ["date_of_pricing", "arrival_in_tonnes", "minimum_price", "maximum_price"]
    assert got[7, "rejected"]["landed"]["ARRIVAL_IN_TONNES"] == "1.005" and got[7, "typed"]["landed"] is None
    assert got[7, "typed"]["rejected_columns"] is None and str(got[7, "typed"]["arrival_in_tonnes"]) == "1.01"
    plan = split_outcomes(spark.range(1).selectExpr(
        *[f"cast(rand() as string) AS {c}" for c in S.RAW_PRICING.fieldNames()], "current_timestamp() AS source_file_load_date"
    ))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
