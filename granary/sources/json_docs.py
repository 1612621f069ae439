"""JSON responses and JSON tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from granary import schemas as S
from granary.operators.nested import with_results


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines; a schema saves the inference scan and keeps absent fields as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


_BROKEN = "_broken"


def parse_responses(
    lines: DataFrame, schema: StructType, text: str = "value", tags: tuple[str, ...] = ()
) -> DataFrame:
    """Response texts parsed once: tags, the fields of `schema`, `response` and `outcomes`.

    outcomes holds "landed" where the text is a JSON object, and "rejected" where it is broken, no object, or has a value of another
    type than the schema says; such an object is both, with NULL for that value, unless nothing of it is left. `response` is
    the text of rejects. A tag replaces a field of the same name.
    """
    with_broken = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = lines.select(*tags, F.col(text).alias("response"), F.from_json(text, with_broken, options).alias("_response"))
    bad = F.col("_response").isNull() | F.col(f"_response.{_BROKEN}").isNotNull()
    left = reduce(lambda a, b: a | b, (F.col(f"_response.{f}").isNotNull() for f in schema.fieldNames()))
    landed = F.col("_response").isNotNull() & (~bad | left)
    fields = [F.col(f"_response.{f}").alias(f) for f in schema.fieldNames() if f not in tags]
    outcomes = F.array_compact(F.array(F.when(landed, F.lit("landed")), F.when(bad, F.lit("rejected"))))
    return parsed.select(*tags, *fields, F.when(bad, F.col("response")).alias("response"), outcomes.alias("outcomes"))


def land_responses(
    lines: DataFrame, schema: StructType, text: str = "value", tags: tuple[str, ...] = ()
) -> DataFrame:
    """One row per response text that is a JSON object, tagged with other columns of `lines`."""
    parsed = parse_responses(lines, schema, text, tags)
    return parsed.where(F.array_contains("outcomes", "landed")).drop("response", "outcomes")


def rejected_responses(
    lines: DataFrame, schema: StructType, text: str = "value", tags: tuple[str, ...] = ()
) -> DataFrame:
    """Tags and text of the responses that `parse_responses` rejects."""
    parsed = parse_responses(lines, schema, text, tags)
    return parsed.where(F.array_contains("outcomes", "rejected")).select(*tags, "response")


def write_responses(parsed: DataFrame, path: str) -> None:
    """Overwrite a folder by parsed responses as JSON lines, in one pass: a sub-folder of those landed and one of rejects.

    Landed lines hold their fields, rejects their tags and text.
    """
    rows = parsed.withColumn("outcome", F.explode("outcomes")).drop("outcomes")
    landed = F.col("outcome") == "landed"
    tagged = {f: F.when(landed, F.col(f)) for f in rows.columns if f not in ("outcome", "response", "marketName")}
    rows.withColumns({**tagged, "response": F.when(~landed, F.col("response"))}).write.mode("overwrite").partitionBy("outcome").json(path)


def read_responses(spark: SparkSession, path: str, schema: StructType, outcome: str = "landed") -> DataFrame:
    """The landed responses of a folder of `write_responses`, or its rejects."""
    held = spark.read.schema(StructType([*schema.fields, StructField("outcome", StringType())])).json(path)
    return held.where(F.col("outcome") == outcome).drop("outcome")


def land_geocoding(lines: DataFrame, text: str = "value") -> DataFrame:
    """Geocoding responses that carry a result list."""
    return with_results(land_responses(lines, S.GEOCODE_RESPONSE, text))


def land_weather(
    lines: DataFrame, text: str = "value", tags: tuple[str, ...] = ("marketName",)
) -> DataFrame:
    """Weather responses tagged with the market they were asked for."""
    columns = S.WEATHER_RESPONSE.fieldNames()
    return land_responses(lines, S.WEATHER_RESPONSE, text, tags).select(*columns)
