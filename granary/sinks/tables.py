"""Files and catalog tables: append, overwrite, and publish of a new version."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from granary.functions import table_folder

#: Compression of the Parquet files written here: a fifth to two fifths smaller than the default.
CODEC = "zstd"


def sink_path(root: str, table: str) -> str:
    """Folder of a dotted table name below `root`."""
    return f"{root.rstrip('/')}/{table_folder(table)}"


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of `schema` by name and type; missing ones NULL, unknown ones an error."""
    given = {name.lower(): name for name in df.columns}
    unknown = set(given) - {name.lower() for name in schema.fieldNames()}
    if unknown:
        raise ValueError(f"columns not in the target table: {sorted(unknown)}")
    return df.select(
        *(
            (F.col(given[f.name.lower()]) if f.name.lower() in given else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        )
    )


def spread_by(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Few files per table partition: rebalance splits a hot partition over several tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_files(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append to a Parquet folder; new columns are allowed."""
    spread_by(df, partition_by).write.mode("append").partitionBy(*partition_by).option("compression", CODEC).parquet(path)


def read_evolving(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A folder whose files differ in columns; absent values are NULL.

    With a schema only the files a query needs are opened; without one Spark
    reads all file footers, in parallel, to merge theirs.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def create_table(
    spark: SparkSession, name: str, schema: StructType, location: str,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Database and Parquet table at `location`, unless they exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET {parts} LOCATION '{location}'"
    )


def create_json_table(
    spark: SparkSession, name: str, location: str, schema: StructType | None = None
) -> None:
    """Table over a folder of JSON lines; without a schema its columns are inferred once."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) if schema else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} {f'({columns})' if columns else ''} "
        f"USING JSON LOCATION '{location}'"
    )


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table, columns matched by name."""
    conform(df, df.sparkSession.table(name).schema).write.mode("append").insertInto(name)


def add_columns(name: str, df: DataFrame) -> None:
    """Give a catalog table the columns of `df` that it lacks; its older rows read NULL.

    The catalog holds the full schema, so readers never merge file footers.
    """
    spark = df.sparkSession
    known = {column.lower() for column in spark.table(name).columns}
    added = [f for f in df.schema.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _spec(values: dict[str, object]) -> str:
    def text(value: object) -> str:
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return "NULL" if value is None else f"'{quoted}'"

    return ", ".join(f"`{c}` = {text(v)}" for c, v in values.items())


def _folder(spark: SparkSession, path: str, values: dict[str, object]) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path, *(escape(c, None if v is None else str(v)) for c, v in values.items())])


def point_partitions(spark: SparkSession, name: str, path: str, partitions: list[dict[str, object]]) -> None:
    """Let partitions of a catalog table read the folders written for them below `path`.

    Partitions not named stay as they are, and readers that run keep the files they have. Each partition
    changes at once, those that exist one after the other in the given order.
    """
    known = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()} if partitions else set()
    new = [p for p in partitions if _folder(spark, "", p).lstrip("/") not in known]
    for p in partitions:
        if p not in new:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(p)}) SET LOCATION '{_folder(spark, path, p)}'")
    if new:
        places = " ".join(f"PARTITION ({_spec(p)}) LOCATION '{_folder(spark, path, p)}'" for p in new)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    if partitions:
        spark.catalog.refreshTable(name)


def _written(spark: SparkSession, path: str, columns: list[str]) -> list[dict[str, str | None]]:
    """Values of the partition columns below `path` as text, as the folders spell them: one row per partition that was written."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    rows = spark.read.schema(schema).option("basePath", path).parquet(path).distinct().collect()
    return [row.asDict() for row in rows]


def replace_partitions(df: DataFrame, name: str, spread: tuple[str, ...] = (), root: str | None = None) -> None:
    """Replace the table partitions that occur in `df`, which may read that table; a repeated load changes nothing.

    The rows go to a new folder below `root` (default: that of the table); when all are written, the partitions point there. No
    setting of the session is touched, so loads in one session do not disturb each other.
    Rows are written where they are: a run has one batch or few, and an exchange on them would gather
    what the scan has spread. Where many partitions are written at once, `spread` names their columns, for few files in each.
    """
    spark = df.sparkSession
    columns = partition_columns(spark, name)
    rows = spread_by(conform(df, spark.table(name).schema), spread)
    path = f"{root.rstrip('/') if root else _location(spark, name)}/version-{uuid.uuid4().hex}"
    rows.write.partitionBy(*columns).option("compression", CODEC).parquet(path)
    # Highest first: of a history, closed versions (keyed by the load that closed them) before current ones (keyed 0).
    found = sorted(_written(spark, path, columns), key=lambda p: [(v is not None, v) for v in p.values()], reverse=True)
    point_partitions(spark, name, path, found)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def write_split(
    df: DataFrame, outcome: str, targets: dict[str, str], partition_by: tuple[str, ...], path: str
) -> None:
    """One write for several tables: rows go by `outcome` to the table `targets` names for it.

    The tables point at the folders of that write, and read the columns they have from its files. `df` is computed once.
    """
    spark = df.sparkSession
    df.write.partitionBy(outcome, *partition_by).option("compression", CODEC).parquet(path)
    found = _written(spark, path, [outcome, *partition_by])
    for value, name in targets.items():
        mine = [{c: p[c] for c in partition_by} for p in found if p[outcome] == value]
        point_partitions(spark, name, _folder(spark, path, {outcome: value}), mine)


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a managed table, schema included."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    df.write.mode("overwrite").saveAsTable(name)


def publish(df: DataFrame, name: str, location: str) -> str:
    """Replace the rows of an unpartitioned catalog table by `df`, which may read that table.

    The rows go to a new folder below `location`; only when all are written does the
    table point there. A failed job leaves the old version in place, and running
    readers keep their files. Old folders are left for the retention of the store.
    """
    spark = df.sparkSession
    path = f"{location.rstrip('/')}/version-{uuid.uuid4().hex}"
    conform(df, spark.table(name).schema).write.option("compression", CODEC).parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return path
