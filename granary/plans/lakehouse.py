"""Names, places and definitions of the lakehouse tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, IntegerType, LongType, StringType, StructField, StructType

from granary import schemas as S
from granary.sinks import tables

# Key of the landing run a row came with. It partitions the large tables, so an
# incremental read lists only new runs and a repeated load replaces whole runs.
LOAD_BATCH = "load_batch"

# Hash bucket of a product's name (dimension) or id (history): a load rewrites only the buckets it changes.
BUCKET = "bucket"
BUCKETS = 16
# Load that closed a version of the history, in microseconds, 0 for current ones: closed versions are never rewritten.
CLOSED_BY = "closed_by"

BRONZE = "bronze_market.daily_pricing_bronze"
RUN_LOG = "bronze_processrunlogs.process_runs"
SILVER = "silver_market.daily_pricing_silver"
REJECTED = "silver_market.rejected_prices"
LOCATIONS = "silver_market.geo_location_silver"
WEATHER = "silver_market.weather_data_trans"
DIM_STATE = "gold_market.dim_state"
DIM_MARKET = "gold_market.dim_market"
DIM_VARIETY = "gold_market.dim_variety"
DIM_PRODUCT = "gold_market.dim_product"
DIM_PRODUCT_SCD2 = "gold_market.dim_product_scd2"
DIM_DATE = "gold_market.dim_date"
FACT = "gold_market.fact_daily_pricing"
REPORT = "gold_market.price_weather_report"

SCHEMAS: dict[str, StructType] = {
    RUN_LOG: S.COUNTED_RUN_LOG,
    LOCATIONS: S.GEO_LOCATION,
    WEATHER: S.WEATHER_DATA,
    DIM_STATE: S.DIM_STATE,
    DIM_MARKET: S.DIM_MARKET,
    DIM_VARIETY: S.DIM_VARIETY,
    DIM_DATE: S.DIM_DATE,
    REPORT: S.PRICE_WEATHER_REPORT,
}


PARTITIONED: dict[str, tuple[StructType, tuple[tuple[str, DataType], ...]]] = {
    BRONZE: (S.LANDED_PRICING, ((LOAD_BATCH, LongType()), ("file_date", DateType()))),
    SILVER: (S.SILVER_PRICING, ((LOAD_BATCH, LongType()),)),
    REJECTED: (
        StructType([StructField("landed", S.LANDED_PRICING), StructField("rejected_columns", ArrayType(StringType()))]),
        ((LOAD_BATCH, LongType()),),
    ),
    FACT: (S.FACT_PRICING, ((LOAD_BATCH, LongType()),)),
    DIM_PRODUCT: (S.DIM_PRODUCT, ((BUCKET, IntegerType()),)),
    DIM_PRODUCT_SCD2: (S.DIM_PRODUCT_SCD2, ((CLOSED_BY, LongType()), (BUCKET, IntegerType()))),
}


def bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Lakehouse:
    """A session, the root folder of all layers, and a prefix of the database names (two lakes in one catalog need two)."""

    spark: SparkSession
    root: str
    prefix: str = ""

    @property
    def bronze_locations(self) -> str:
        return f"{self.root}/bronze/geo-location"

    @property
    def bronze_weather(self) -> str:
        return f"{self.root}/bronze/weather-data"

    @property
    def reference_data(self) -> str:
        return f"{self.root}/bronze/reference-data"

    def name(self, table: str) -> str:
        """Name of a table in the catalog."""
        return f"{self.prefix}{table}"

    def location(self, table: str) -> str:
        return tables.sink_path(self.root, table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def create(self) -> None:
        """All databases and tables that do not exist yet."""
        for table, schema in SCHEMAS.items():
            tables.create_table(self.spark, self.name(table), schema, self.location(table))
        for table, (schema, partitions) in PARTITIONED.items():
            full = StructType(schema.fields + [StructField(c, t, True) for c, t in partitions])
            columns = tuple(c for c, _ in partitions)
            tables.create_table(self.spark, self.name(table), full, self.location(table), columns)

    def drop(self) -> None:
        """Take the tables out of the catalog; their files stay."""
        for table in [*SCHEMAS, *PARTITIONED]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def log(self, entry: DataFrame) -> None:
        """Append rows to the run log."""
        tables.append_table(entry, self.name(RUN_LOG))

    def publish(self, df: DataFrame, table: str) -> None:
        """Replace a small table by a new version that may be computed from the old one."""
        tables.publish(df, self.name(table), self.location(table))

    def add_columns(self, table: str, df: DataFrame) -> None:
        tables.add_columns(self.name(table), df)

    def batches(self, table: str, keys: list[int]) -> DataFrame:
        """Rows of some load batches; only their partitions are listed."""
        return self.table(table).where(F.col(LOAD_BATCH).isin(keys))

    def replace_batches(self, df: DataFrame, table: str) -> None:
        """Replace the partitions that occur in `df`, and no others. `df` may read the table."""
        tables.replace_partitions(df, self.name(table), root=self.location(table))
        self.spark.catalog.refreshTable(self.name(table))  # `df` may belong to another session

    def write_outcomes(self, df: DataFrame) -> None:
        """Typed rows and rejects (column outcome) of some batches in one write."""
        path = f"{self.root}/silver_market/price-outcomes/version-{uuid.uuid4().hex}"
        targets = {"typed": self.name(SILVER), "rejected": self.name(REJECTED)}
        tables.write_split(df, "outcome", targets, (LOAD_BATCH,), path)

    def rejected_prices(self) -> DataFrame:
        """Landed price rows with a value that did not parse: their text, the columns and the batch."""
        return self.table(REJECTED).select("landed.*", "rejected_columns", LOAD_BATCH)
