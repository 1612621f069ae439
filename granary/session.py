"""Session settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# AQE picks the final partition count, turns small sides into broadcasts at run
# time and splits skewed join partitions; a skew split may add one shuffle, which
# beats one task holding a third of the rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the recommended settings; the cluster's own master and conf win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.ui.enabled", "false")
                .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
                .config("spark.sql.shuffle.partitions", "8")
            )
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
