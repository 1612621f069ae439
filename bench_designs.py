"""Time the chosen form of an operator against the plain one it replaces.

    python bench_designs.py        ($BENCH_SF_DIR, $BENCH_CPUS as for bench.py)
"""

from __future__ import annotations

import functools
import json
import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.operators import nested
from granary.operators.ids import dense_ids
from granary.operators.lookups import full_outer
from granary.operators.report import price_weather_report
from granary.session import build_session
from granary.staging import stage
from workload import base

FIELDS = ("admin1", "admin2", "country", "latitude", "longitude", "name", "population")


def positional_join(responses):
    """Each field of the results exploded with its position, and joined back on it."""
    keyed = responses.select("reply", *(F.col(f"results.{f}").alias(f) for f in FIELDS))
    parts = [
        keyed.select("reply", F.posexplode(f).alias("pos", f)) for f in FIELDS
    ]
    return functools.reduce(lambda a, b: a.join(b, ["reply", "pos"]), parts)


def native_report(silver, geo, weather):
    """Two native full outer joins and a distinct over the result."""
    p, g, w = silver.alias("p"), geo.alias("g"), weather.alias("w")
    day = F.expr("try_cast(w.weatherDate AS DATE)")
    return (
        p.join(g, F.expr("p.state_name = g.stateName AND p.market_name = g.marketName"), "full")
        .join(w, (F.col("w.marketName") == F.col("p.market_name")) & (day == F.col("p.date_of_pricing")), "full")
        .select("p.*", "g.latitude", "g.longitude", "g.population", "w.unitOfTemparature",
                "w.maximumTemparature", "w.minimumTemparature", "w.unitOfRainFall", "w.rainFall")
        .distinct()
    )


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "designs", f"local[{cpus}]",
        {"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    keys = stage(base.table(spark, sf, "lineitem").select("l_orderkey").distinct())
    replies = stage(base.geocoding(spark, sf))
    silver = base.silver(spark, sf)
    geo = stage(nested.flatten_locations(base.market_locations(spark, sf)))
    days = stage(nested.flatten_weather(base.weather(spark, sf)))
    orders = base.table(spark, sf, "orders")
    customers = base.table(spark, sf, "customer")
    asia = stage(silver.where("state_name = 'ASIA'").select("origin").distinct())
    origins = silver.select("origin").distinct()
    window = F.row_number().over(Window.orderBy("l_orderkey"))
    pairs = {
        "dense ids: ranges": lambda: dense_ids(keys, ["l_orderkey"], "id"),
        "dense ids: one window": lambda: keys.withColumn("id", window),
        "flatten: inline": lambda: nested.flatten_locations(replies),
        "flatten: positional joins": lambda: positional_join(replies),
        "new members: left anti": lambda: origins.join(asia, "origin", "left_anti"),
        "new members: left and IS NULL": lambda: origins.alias("o").join(
            asia.alias("a"), F.expr("o.origin = a.origin"), "left"
        ).where("a.origin IS NULL").select("o.*"),
        "full outer: left and anti": lambda: full_outer(orders, customers, [("o_custkey", "c_custkey")]),
        "full outer: native": lambda: orders.join(customers, F.expr("o_custkey = c_custkey"), "full"),
        "report: distinct first": lambda: price_weather_report(silver, geo, days),
        "report: two full joins": lambda: native_report(silver, geo, days),
    }
    seconds = {}
    for name, build in pairs.items():
        taken = []
        for _ in range(5):
            began = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps(seconds, indent=1))


if __name__ == "__main__":
    main()
