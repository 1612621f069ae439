"""Table schemas and the fixed values of the price lakehouse."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Names, formats and defaults the source systems and the users
# of the tables rely on. Spellings (e.g. "Temparature") are part of the data.
# ---------------------------------------------------------------------------
DAILY_FILE_PREFIX = "PW_MW_DR_"
DAILY_FILE_DATE_FORMAT = "MMddyyyy"
DAILY_FILE_PATTERN = r"PW_MW_DR_(\d{8})\.csv"
PRICING_DATE_FORMAT = "MM/dd/yyyy"
CALENDAR_DATE_FORMAT = "dd/MM/yyyy"
FIRST_FILE_DATE = "2023-01-01"
FIRST_LOAD_STAMP = "1900-01-01"
STATUS_COMPLETED = "Completed"
STATUS_FAILED = "Failed"
PROCESS_INGEST = "dailyPricingSourceIngest"
PROCESS_SILVER = "daily_pricing_silver"
PROCESS_DIMENSIONS = "gold_dimension_load"
PROCESS_FACT = "gold_fact_daily_pricing_load"
GEOCODE_URL = "https://geocoding-api.open-meteo.com/v1/search?name="
GEOCODE_OPTIONS = "&count=10&language=en&format=json"
WEATHER_URL = "https://archive-api.open-meteo.com/v1/archive?latitude="
WEATHER_OPTIONS = "&daily=temperature_2m_max,temperature_2m_min,rain_sum"
WEATHER_START = "2023-01-01"
WEATHER_END = "2024-01-01"
REFERENCE_TABLES = (
    "masterdata.market_address",
    "masterdata.country_profile",
    "masterdata.exchange_rates",
    "masterdata.domestic_product_codes",
    "masterdata.global_item_codes",
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


_STR, _LONG, _TS = StringType(), LongType(), TimestampType()
TONNES = DecimalType(18, 2)
MONEY = DecimalType(36, 2)

PRICING_COLUMNS = (
    "DATE_OF_PRICING",
    "ROW_ID",
    "STATE_NAME",
    "MARKET_NAME",
    "PRODUCTGROUP_NAME",
    "PRODUCT_NAME",
    "VARIETY",
    "ORIGIN",
    "ARRIVAL_IN_TONNES",
    "MINIMUM_PRICE",
    "MAXIMUM_PRICE",
    "MODAL_PRICE",
)

# The daily file is landed as text; types come in the cleaning step.
RAW_PRICING = _struct(*((name, _STR) for name in PRICING_COLUMNS))
LANDED_PRICING = StructType(RAW_PRICING.fields + [StructField("source_file_load_date", _TS, True)])

SILVER_PRICING = _struct(
    ("date_of_pricing", DateType()),
    ("row_id", _LONG),
    ("state_name", _STR),
    ("market_name", _STR),
    ("productgroup_name", _STR),
    ("product_name", _STR),
    ("variety", _STR),
    ("origin", _STR),
    ("arrival_in_tonnes", TONNES),
    ("minimum_price", MONEY),
    ("maximum_price", MONEY),
    ("modal_price", MONEY),
    ("source_file_load_date", _TS),
    ("created_at", _TS),
    ("updated_at", _TS),
)

# `watermark_ts` keeps the full precision of a load stamp next to the DATE. The counts are those a step has observed
# while it wrote; NULL where a step counts nothing.
RUN_LOG = _struct(
    ("process_name", _STR),
    ("processed_file_table_date", DateType()),
    ("process_status", _STR),
    ("run_timestamp", _TS),
    ("watermark_ts", _TS),
)
#: The run log of the daily load, whose steps count their rows.
COUNTED_RUN_LOG = StructType(
    [*RUN_LOG.fields, *_struct(("rows_read", _LONG), ("rows_written", _LONG), ("rows_rejected", _LONG)).fields]
)

_STAMPS = (("created_at", _TS), ("updated_at", _TS))
DIM_STATE = _struct(("state_id", _LONG), ("state_name", _STR), *_STAMPS)
DIM_MARKET = _struct(("market_id", _LONG), ("market_name", _STR), *_STAMPS)
DIM_VARIETY = _struct(("variety_id", _LONG), ("variety", _STR), *_STAMPS)
DIM_PRODUCT = _struct(
    ("product_id", _LONG), ("productgroup_name", _STR), ("product_name", _STR), *_STAMPS
)
DIM_DATE = _struct(("date_id", _LONG), ("calendar_date", _STR))
DIM_PRODUCT_SCD2 = _struct(
    ("product_sk", _LONG),
    ("product_id", _LONG),
    ("productgroup_name", _STR),
    ("product_name", _STR),
    ("effective_start_date", _TS),
    ("effective_end_date", _TS),
    ("is_current", BooleanType()),
    *_STAMPS,
)
FACT_PRICING = _struct(
    ("date_id", _LONG),
    ("state_id", _LONG),
    ("market_id", _LONG),
    ("product_id", _LONG),
    ("variety_id", _LONG),
    ("row_id", _LONG),
    ("arrival_in_tonnes", TONNES),
    ("maximum_price", MONEY),
    ("minimum_price", MONEY),
    ("modal_price", MONEY),
    *_STAMPS,
)

GEOCODE_RESULT = _struct(
    ("admin1", _STR),
    ("admin2", _STR),
    ("country", _STR),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("name", _STR),
    ("population", _LONG),
)
GEOCODE_RESPONSE = _struct(("results", ArrayType(GEOCODE_RESULT)))

WEATHER_DAILY = _struct(
    ("time", ArrayType(_STR)),
    ("temperature_2m_max", ArrayType(DoubleType())),
    ("temperature_2m_min", ArrayType(DoubleType())),
    ("rain_sum", ArrayType(DoubleType())),
)
WEATHER_RESPONSE = _struct(
    ("marketName", _STR),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("daily", WEATHER_DAILY),
    ("daily_units", _struct(("temperature_2m_max", _STR), ("rain_sum", _STR))),
)

GEO_LOCATION = _struct(
    ("stateName", _STR),
    ("districtName", _STR),
    ("countryName", _STR),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("marketName", _STR),
    ("population", _LONG),
)
WEATHER_DATA = _struct(
    ("marketName", _STR),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("weatherDate", _STR),
    ("maximumTemparature", DoubleType()),
    ("unitOfTemparature", _STR),
    ("minimumTemparature", DoubleType()),
    ("rainFall", DoubleType()),
    ("unitOfRainFall", _STR),
    ("sequenceId", _LONG),
)
PRICE_WEATHER_REPORT = StructType(
    SILVER_PRICING.fields[:12]
    + _struct(
        ("MARKET_LATITUDE", DoubleType()),
        ("MARKET_LONGITUDE", DoubleType()),
        ("MARKET_POPULATION", _LONG),
        ("TEMPARATURE_UNIT", _STR),
        ("MARKET_MAX_TEMPARATURE", DoubleType()),
        ("MARKET_MIN_TEMPARATURE", DoubleType()),
        ("RAINFALL_UNIT", _STR),
        ("MARKET_DAILY_RAINFALL", DoubleType()),
        ("lakehouse_inserted_date", _TS),
        ("lakehouse_updated_date", _TS),
    ).fields
)
