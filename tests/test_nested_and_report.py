import datetime as dt
import itertools

import pytest

from granary import schemas as S
from granary.operators import nested
from granary.operators.lookups import full_outer, lookup, unmatched_right
from granary.operators.report import price_weather_report
from granary.operators.requests import geocode_requests, weather_requests
from granary.sources.json_docs import land_geocoding, land_weather


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GEO = (
    '{"results":[{"admin1":"S","name":"M","latitude":1.5,"longitude":2.5,"population":7},{"name":"N"}]}',
    '{"results":[]}',
    '{"generationtime_ms":0.5}',
    '{"results":[{"name":"X"},null]}',
    '[{"results":[{"name":"listed"}]}]',
    "not json",
)


def test_geocoding_landing_and_rows(spark):
    landed = land_geocoding(lines(spark, *GEO))
    assert landed.count() == 3
    rows = nested.flatten_locations(landed)
    assert rows.schema.fieldNames() == S.GEO_LOCATION.fieldNames()
    got = sorted((tuple(r) for r in rows.collect()), key=str)
    assert got == sorted(
        [
            ("S", None, None, 1.5, 2.5, "M", 7),
            (None, None, None, None, None, "N", None),
            (None, None, None, None, None, "X", None),
            (None,) * 7,
        ],
        key=str,
    )


def weather_lines(spark):
    day = '{"latitude":1.0,"longitude":2.0,"daily":%s,"daily_units":{"temperature_2m_max":"C","rain_sum":"mm"}}'
    rows = [
        ("even", day % '{"time":["2023-01-01","2023-01-02"],"temperature_2m_max":[1,null],"temperature_2m_min":[0,0.5],"rain_sum":[0,9]}'),
        ("short", day % '{"time":["2023-01-01","2023-01-02"],"temperature_2m_max":[1],"temperature_2m_min":[0,0.5]}'),
        ("none", day % '{"rain_sum":[1]}'),
        ("reason", '{"error":true}'),
        ("text", '"quota exceeded"'),
    ]
    return spark.createDataFrame(rows, "marketName string, value string")


def test_weather_rows_are_aligned(spark):
    landed = land_weather(weather_lines(spark))
    assert landed.count() == 4
    rows = nested.flatten_weather(landed)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in S.WEATHER_DATA]
    got = sorted((r["marketName"], r["weatherDate"], r["maximumTemparature"], r["minimumTemparature"], r["rainFall"]) for r in rows.collect())
    assert got == [
        ("even", "2023-01-01", 1.0, 0.0, 0.0), ("even", "2023-01-02", None, 0.5, 9.0),
        ("short", "2023-01-01", 1.0, 0.0, None), ("short", "2023-01-02", None, 0.5, None),
    ]
    assert rows.select("sequenceId").distinct().count() == 4
    bad = nested.weather_length_mismatch(landed).select("marketName").collect()
    assert sorted(r[0] for r in bad) == ["none", "reason", "short"]


def test_cross_product_in_order(spark):
    docs = [(1, ["a", "b"], [1, 2, 3]), (2, [], [1]), (3, None, [1]), (4, ["c"], [9]), (0, ["z", None], [5])]
    df = spark.createDataFrame(docs, "k int, p array<string>, q array<int>")
    everything = [
        (k, p, q) for k, ps, qs in sorted(docs, key=lambda d: d[0]) for p, q in itertools.product(ps or [], qs)
    ]
    for limit in (1, 2, 4, 100):
        got = nested.explode_cross(df, ["p", "q"], limit, ["k"]).orderBy("sequenceId").collect()
        assert [tuple(r)[:3] for r in got] == everything[:limit]
        assert [r["sequenceId"] for r in got] == list(range(min(limit, len(everything))))


def test_requests(spark):
    dim = spark.createDataFrame([(1, "New Delhi+"), (2, "Agra")], "market_id long, market_name string")
    urls = {r["marketName"]: r["url"] for r in geocode_requests(dim, base_url="u?name=", options="&x").collect()}
    assert urls == {"New Delhi+": "u?name=New%20Delhi%2B&x", "Agra": "u?name=Agra&x"}
    assert [r["marketName"] for r in geocode_requests(dim, limit=1).collect()] == ["Agra"]
    place = spark.createDataFrame([(28.5, -77.25, "Agra")], "latitude double, longitude double, marketName string")
    url = weather_requests(place, "2023-01-01", dt.date(2023, 2, 1), base_url="u?lat=", options="&d").first()["url"]
    assert url == "u?lat=28.5&longitude=-77.25&start_date=2023-01-01&end_date=2023-02-01&d"


def frames(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "m")], "j int, w string")
    return left, right


def test_full_outer_is_the_native_one(spark):
    left, right = frames(spark)
    got = full_outer(left, right, [("k", "j")])
    want = left.join(right, left.k == right.j, "full")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert unmatched_right(left, right, [("k", "j")]).count() == 2


def test_lookup_keeps_every_row(spark):
    left, right = frames(spark)
    dim = right.where("w != 'y'").withColumnRenamed("j", "k")
    got = sorted((r["v"], r["w"]) for r in lookup(left, dim, ["k"], ["w"]).collect())
    assert got == [("a", "x"), ("b", "x"), ("c", None), ("n", None)]


PRICE = S.SILVER_PRICING.fieldNames()[:12]


def report_inputs(spark):
    def price(day, state, market, row):
        values = dict.fromkeys(PRICE)
        values |= {"date_of_pricing": day, "row_id": row, "state_name": state, "market_name": market}
        return tuple(values.values()) + (None, None, None)

    d1, d2 = dt.date(2023, 1, 1), dt.date(2023, 1, 2)
    silver = [
        price(d1, "S", "M", 1), price(d1, "S", "M", 1), price(d2, "S", "M", 2), price(d1, "T", "M", 3),
        price(d1, None, "M", 4), price(None, "S", "M", 5), price(d1, "S", None, 6), price(None, None, None, None),
        price(None, None, None, None),
    ]
    geo = [
        ("S", None, None, 1.0, 1.0, "M", 10), ("S", "d", "c", 1.0, 1.0, "M", 10), ("S", None, None, 2.0, 2.0, "M", None),
        ("U", None, None, 3.0, 3.0, "M", 1), ("V", None, None, 3.0, 3.0, "Q", 1), (None, None, None, None, None, None, None),
    ]
    weather = [
        ("M", 0.0, 0.0, "2023-01-01", 30.0, "C", 20.0, 1.0, "mm", 0), ("M", 9.0, 9.0, "2023-01-01", 30.0, "C", 20.0, 1.0, "mm", 1),
        ("M", 0.0, 0.0, "2023-01-01", 31.0, "C", 20.0, 1.0, "mm", 2), ("M", 0.0, 0.0, "2023-01-09", 5.0, "C", 1.0, 0.0, "mm", 3),
        ("N", 0.0, 0.0, "2023-01-01", 5.0, "C", 1.0, 0.0, "mm", 4), ("M", 0.0, 0.0, "soon", 7.0, "C", 1.0, 0.0, "mm", 5),
        ("M", 0.0, 0.0, None, None, None, None, None, None, 6),
    ]
    return (
        spark.createDataFrame(silver, S.SILVER_PRICING),
        spark.createDataFrame(geo, S.GEO_LOCATION),
        spark.createDataFrame(weather, S.WEATHER_DATA),
    )


def native_report(spark, silver, geo, weather):
    for name, df in (("p", silver), ("g", geo), ("w", weather)):
        df.createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT DISTINCT {', '.join('p.' + c for c in PRICE)}, g.latitude, g.longitude, g.population,
               w.unitOfTemparature, w.maximumTemparature, w.minimumTemparature, w.unitOfRainFall, w.rainFall
        FROM p FULL JOIN g ON p.state_name = g.stateName AND p.market_name = g.marketName
        FULL JOIN w ON w.marketName = p.market_name AND p.date_of_pricing = try_cast(w.weatherDate AS DATE)""")


def test_report_is_distinct_over_two_full_joins(spark):
    inputs = report_inputs(spark)
    report = price_weather_report(*inputs, as_of="2024-01-01")
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in S.PRICE_WEATHER_REPORT]
    got = report.drop("lakehouse_inserted_date", "lakehouse_updated_date").collect()
    want = native_report(spark, *inputs).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(tuple(r)) for r in want)


@pytest.mark.parametrize("empty", range(3))
def test_report_with_an_empty_input(spark, empty):
    inputs = [df.limit(0) if i == empty else df for i, df in enumerate(report_inputs(spark))]
    got = price_weather_report(*inputs).drop("lakehouse_inserted_date", "lakehouse_updated_date").collect()
    want = native_report(spark, *inputs).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(tuple(r)) for r in want)
