import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from granary import schemas as S
from granary.operators.facts import build_fact
from granary.operators.checks import DuplicateKeyError
from granary.plans import daily, places
from granary.plans import lakehouse as names
from granary.plans.lakehouse import Lakehouse
from granary.sources.json_docs import land_weather, read_responses, rejected_responses
from granary.streaming import daily as streamed

HEADER = ",".join(S.PRICING_COLUMNS)


def write_day(folder, day, *rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / f"PW_MW_DR_{day:%m%d%Y}.csv").write_text("\n".join([header, *rows]) + "\n")


def price(day, row, state="S", market="M", group="g", product="p"):
    return f"{day:%m/%d/%Y},{row},{state},{market},{group},{product},v,o,1.5,1,3,2"


D1, D2, D4 = dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 4)


@pytest.fixture
def lake(spark, tmp_path):
    made = Lakehouse(spark, str(tmp_path / "lake"))
    yield made
    made.drop()


def run(lake, folder, as_of):
    return daily.run_daily(lake, str(folder), "2023-01-01", "2023-12-31", as_of)


def facts(lake):
    rows = lake.table(names.FACT).collect()
    return sorted((r["row_id"], r["date_id"], r["state_id"], r["market_id"], r["product_id"], r["variety_id"]) for r in rows)


def test_daily_load_from_files_to_facts(lake, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    assert run(lake, folder, "2023-06-01 01:00:00") == 0

    write_day(folder, D1, price(D1, 1), price(D1, 2, state="R"))
    assert run(lake, folder, "2023-06-01 02:00:00") == 1
    assert facts(lake) == [(1, 1, 2, 1, 1, 1), (2, 1, 1, 1, 1, 1)]

    assert run(lake, folder, "2023-06-01 03:00:00") == 0
    assert len(facts(lake)) == 2
    assert lake.table(names.SILVER).count() == 2

    # Two files at once, a day between them missing, one header in another order.
    write_day(folder, D2, price(D2, 3, state="A", product="q"))
    text = price(D4, 4, group="h").split(",")
    header = ",".join([*reversed(S.PRICING_COLUMNS), "GRADE"])
    write_day(folder, D4, ",".join([*reversed(text), "A"]), header=header)
    assert run(lake, folder, "2023-06-02 02:00:00") == 2
    assert facts(lake) == [(1, 1, 2, 1, 1, 1), (2, 1, 1, 1, 1, 1), (3, 2, 3, 1, 2, 1), (4, 4, 2, 1, 1, 1)]
    history = lake.table(names.DIM_PRODUCT_SCD2).orderBy("product_sk").collect()
    assert [(r["product_id"], r["productgroup_name"], r["is_current"]) for r in history] == [
        (1, "g", False), (1, "h", True), (2, "g", True),
    ]
    grades = {r["ROW_ID"]: r["GRADE"] for r in lake.table(names.BRONZE).collect()}
    assert grades == {"1": None, "2": None, "3": None, "4": "A"}
    log = lake.table(names.RUN_LOG).where("process_status = 'Failed'")
    assert log.count() == 0


def test_late_files_and_several_groups_lose_no_fact(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, *[price(D1, n, group=g) for n, g in enumerate("abc")])
    write_day(folder, D4, price(D4, 10, group="a"))
    assert run(lake, folder, "2023-06-01 01:00:00") == 2
    write_day(folder, D2, price(D2, 20, group="z"))  # later than D4's file
    assert daily.ingest_prices(lake, str(folder), "2023-06-02 01:00:00") == 1
    D5 = dt.date(2023, 1, 5)
    write_day(folder, D5, price(D5, 30, group="c"), price(D5, 31, product="n").replace(",1.5,", ",x t,"))
    assert daily.ingest_prices(lake, str(folder), "2023-06-02 02:00:00") == 1  # two open batches
    assert run(lake, folder, "2023-06-02 03:00:00") == 0
    found = {row_id: product for row_id, _, _, _, product, _ in facts(lake)}
    assert set(found) == {0, 1, 2, 10, 20, 30, 31}
    assert None not in found.values()
    assert found[0] == found[10] and found[2] == found[30] and len(set(found.values())) == 5
    rejected = lake.rejected_prices().collect()
    assert [(r["ROW_ID"], r["rejected_columns"]) for r in rejected] == [("31", ["arrival_in_tonnes"])]


def test_silver_is_written_without_a_shuffle(lake, tmp_path, spark):
    write_day(tmp_path / "in", D1, price(D1, 1))
    lake.create()
    daily.ingest_prices(lake, str(tmp_path / "in"), "2023-06-01 01:00:00")
    plans = []
    original = names.tables.write_split

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        original(df, *args)

    names.tables.write_split = seen
    try:
        daily.load_silver(lake, "2023-06-01 02:00:00")
    finally:
        names.tables.write_split = original
    # One pass over the landed batch gives typed rows and rejects, without an exchange.
    assert len(plans) == 1 and "Exchange" not in plans[0] and plans[0].count("FileScan") == 1


def lose_the_log(monkeypatch, step, *args):
    """Run a step whose process dies after its work and before its log row."""
    with monkeypatch.context() as patch:
        patch.setattr(Lakehouse, "log", lambda self, entry: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            step(*args)


def test_every_step_can_be_repeated_after_a_crash(lake, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    write_day(tmp_path / "in", D1, price(D1, 1))
    lake.create()
    daily.load_date_dim(lake, "2023-01-01", "2023-12-31")
    steps = [(daily.ingest_prices, folder), (daily.load_silver,), (daily.load_dimensions,), (daily.load_facts,)]
    for n, (step, *args) in enumerate(steps):
        lose_the_log(monkeypatch, step, lake, *args, f"2023-06-01 0{n}:10:00")
        for later, *_ in steps[n + 1:]:
            later(lake, "2023-06-01 09:00:00")  # must not take a batch that is not completed
        assert lake.table(names.FACT).count() == 0 or n == 3
        step(lake, *args, f"2023-06-01 0{n}:20:00")
    assert lake.table(names.SILVER).count() == 1
    assert facts(lake) == [(1, 1, 1, 1, 1, 1)]
    # The landing that got lost left rows behind, in a batch that nothing reads.
    assert lake.table(names.BRONZE).count() == 2
    assert lake.table(names.BRONZE).select(names.LOAD_BATCH).distinct().count() == 2


def test_load_time_must_move_on(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, price(D1, 1))
    lake.create()
    daily.ingest_prices(lake, str(folder), "2023-06-01 01:00:00")
    write_day(folder, D2, price(D2, 2))
    with pytest.raises(ValueError, match="load time"):
        daily.ingest_prices(lake, str(folder), "2023-06-01 01:00:00")
    assert daily.ingest_prices(lake, str(folder), "2023-06-01 01:00:01") == 1


def test_failure_is_logged_and_raised(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, "x", header="ONLY")
    lake.create()
    with pytest.raises(Exception):
        daily.ingest_prices(lake, str(folder), on_drift="error")
    row = lake.table(names.RUN_LOG).first()
    assert (row["process_name"], row["process_status"], row["processed_file_table_date"]) == (
        S.PROCESS_INGEST, "Failed", D1,
    )


def test_places_load_and_report(lake, spark):
    geo = spark.createDataFrame(
        [('{"results":[{"admin1":"S","name":"M","latitude":1.0,"longitude":2.0,"population":3}]}',), ("[]",)],
        "value string",
    )
    text = '{"latitude":1.0,"longitude":2.0,"daily":{"time":["2023-01-01"],"temperature_2m_max":[9],"temperature_2m_min":[1],"rain_sum":[0]},"daily_units":{"temperature_2m_max":"C","rain_sum":"mm"}}'
    weather = spark.createDataFrame([("M", text)], "marketName string, value string")
    for _ in range(2):
        places.run_places(lake, geo, weather, "2024-01-01")
    assert lake.table(names.LOCATIONS).count() == lake.table(names.WEATHER).count() == 1
    assert lake.table(names.REPORT).count() == 2
    assert places.location_requests(lake).first()["url"].endswith("rain_sum")
    assert places.market_requests(lake, 10).count() == 0


def test_fact_refuses_a_dimension_with_a_repeated_key(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    twice = spark.createDataFrame([(1, "S", None, None), (2, "S", None, None)], S.DIM_STATE)
    dims = [empty(S.DIM_DATE), twice, empty(S.DIM_MARKET), empty(S.DIM_PRODUCT), empty(S.DIM_VARIETY)]
    with pytest.raises(DuplicateKeyError, match="state_id"):
        build_fact(empty(S.SILVER_PRICING), *dims)


def places_of(lake, table):
    """Folder of each partition of a table."""
    rows = lake.table(table).select("*", F.col("_metadata.file_path").alias("path"))
    parts = [c for c in (names.CLOSED_BY, names.BUCKET) if c in rows.columns]
    return {tuple(r[:-1]): r[-1] for r in rows.select(*parts, F.regexp_extract("path", "(version-[^/]+)/", 1)).distinct().collect()}


def test_a_changed_product_rewrites_its_bucket_only(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, *[price(D1, n, product=f"p{n}") for n in range(60)])
    assert run(lake, folder, "2023-06-01 01:00:00") == 1
    before = {t: places_of(lake, t) for t in (names.DIM_PRODUCT, names.DIM_PRODUCT_SCD2)}
    assert len(before[names.DIM_PRODUCT]) > 8
    write_day(folder, D2, price(D2, 100, product="p7", group="h"), price(D2, 101, product="p8"))
    assert run(lake, folder, "2023-06-02 01:00:00") == 1
    after = {t: places_of(lake, t) for t in before}
    changed = {t: {k for k, v in after[t].items() if before[t].get(k) != v} for t in before}
    assert len(changed[names.DIM_PRODUCT]) == 1
    # The open bucket of the product, and a new partition of the version this load has closed.
    (open_, closed) = sorted(changed[names.DIM_PRODUCT_SCD2])
    assert open_[0] == 0 < closed[0] and open_[1] == closed[1]
    # A third load leaves the closed partition alone.
    write_day(folder, D4, price(D4, 102, product="p7", group="g"))
    run(lake, folder, "2023-06-03 01:00:00")
    assert places_of(lake, names.DIM_PRODUCT_SCD2)[closed] == after[names.DIM_PRODUCT_SCD2][closed]
    held = lake.table(names.DIM_PRODUCT_SCD2).where("product_name = 'p7'").orderBy("product_sk").collect()
    assert [(r["productgroup_name"], r["is_current"]) for r in held] == [("g", False), ("h", False), ("g", True)]
    assert lake.table(names.DIM_PRODUCT).count() == lake.table(names.DIM_PRODUCT).select("product_id").distinct().count() == 60


@pytest.mark.parametrize("lost", [1, 2, 3])
def test_products_survive_a_crash_between_their_tables(lake, tmp_path, monkeypatch, lost):
    """The run ends after the `lost`-th partition of history or dimension has been pointed to its new folder."""
    folder = tmp_path / "in"
    write_day(folder, D1, *[price(D1, n, product=f"p{n}") for n in range(5)])
    run(lake, folder, "2023-06-01 01:00:00")
    write_day(folder, D2, *[price(D2, 10 + n, product=f"p{n}", group="h" if n < 2 else "g") for n in range(9)])
    daily.ingest_prices(lake, str(folder), "2023-06-02 01:00:00")
    write_day(folder, D4, price(D4, 30, product="p0", group="i"))
    daily.ingest_prices(lake, str(folder), "2023-06-02 02:00:00")
    daily.load_silver(lake, "2023-06-02 03:00:00")
    original, seen = names.tables.point_partitions, []

    def some(spark, name, path, partitions):
        for partition in partitions:
            original(spark, name, path, [partition])
            seen.append(partition)
            if len(seen) == lost:
                raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(names.tables, "point_partitions", some)
        with pytest.raises(OSError):
            daily.load_dimensions(lake, "2023-06-02 04:00:00")
    daily.load_dimensions(lake, "2023-06-02 05:00:00")
    daily.load_facts(lake, "2023-06-02 06:00:00")
    held = lake.table(names.DIM_PRODUCT).collect()
    assert len(held) == len({r["product_id"] for r in held}) == 9
    history = lake.table(names.DIM_PRODUCT_SCD2).collect()
    current = {(r["product_id"], r["productgroup_name"], r["product_name"]) for r in history if r["is_current"]}
    assert current == {(r["product_id"], r["productgroup_name"], r["product_name"]) for r in held}
    assert len(history) == len({r["product_sk"] for r in history}) == 12
    ids = {r["product_name"]: r["product_id"] for r in held}
    assert all(f[4] == ids[f"p{f[0] % 10}"] for f in facts(lake))


def test_facts_left_out_find_their_product_later(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, price(D1, 1, group="a"), price(D1, 2, product="n", group=""))
    lake.create()
    daily.load_date_dim(lake, "2023-01-01", "2023-12-31")
    daily.ingest_prices(lake, str(folder), "2023-06-01 01:00:00")
    daily.load_silver(lake, "2023-06-01 02:00:00")
    daily.load_dimensions(lake, "2023-06-01 03:00:00")
    write_day(folder, D2, price(D2, 3, group="b"))
    assert run(lake, folder, "2023-06-02 01:00:00") == 1
    assert [(f[0], f[4]) for f in facts(lake)] == [(1, 2), (2, 1), (3, 2)]


def test_steps_count_what_they_do(lake, tmp_path):
    folder = tmp_path / "in"
    write_day(folder, D1, price(D1, 1), price(D1, 2).replace(",1.5,", ",x t,"))
    run(lake, folder, "2023-06-01 01:00:00")
    log = {r["process_name"]: (r["rows_read"], r["rows_written"], r["rows_rejected"]) for r in lake.table(names.RUN_LOG).collect()}
    assert log[S.PROCESS_INGEST] == (2, 2, None) and log[S.PROCESS_SILVER] == (2, 2, 1) and log[S.PROCESS_FACT] == (2, 2, None)
    assert log[S.PROCESS_DIMENSIONS] == (4, 4, None)


def test_dimensions_scan_a_batch_once(lake, tmp_path, monkeypatch):
    write_day(tmp_path / "in", D1, price(D1, 1))
    lake.create()
    daily.ingest_prices(lake, str(tmp_path / "in"), "2023-06-01 01:00:00")
    daily.load_silver(lake, "2023-06-01 02:00:00")
    reads = []
    original = Lakehouse.batches
    monkeypatch.setattr(Lakehouse, "batches", lambda self, *a: reads.append(a) or original(self, *a))
    daily.load_dimensions(lake, "2023-06-01 03:00:00")
    assert len(reads) == 1


def test_micro_batches_that_are_repeated_replace_themselves(lake, tmp_path, spark):
    folder = tmp_path / "in"
    write_day(folder, D1, price(D1, 1), price(D1, 2).replace(",1.5,", ",x t,"))
    write_day(folder, D2, price(D2, 3, product="q"))
    lake.create()
    daily.load_date_dim(lake, "2023-01-01", "2023-12-31")
    state = str(tmp_path / "state")
    streamed.run_available(lake, str(folder), state, 1).awaitTermination()
    want = facts(lake)
    assert len(want) == 3 and all(None not in f for f in want)
    # The last commit is lost, so the stream repeats its last batch.
    for name in ("1", ".1.crc"):
        os.remove(f"{state}/commits/{name}")
    streamed.run_available(lake, str(folder), state, 1).awaitTermination()
    assert facts(lake) == want and lake.table(names.SILVER).count() == 3 and lake.rejected_prices().count() == 1
    assert lake.table(names.DIM_PRODUCT_SCD2).count() == 2
    streamed.run_available(lake, str(folder), state, 1).awaitTermination()
    assert facts(lake) == want


def test_responses_are_landed_beside_rejects(lake, spark):
    good = '{"results":[{"admin1":"S","name":"M","latitude":1.0,"longitude":2.0,"population":3}]}'
    lines = [good, "[]", '{"results": 5}', '{"none": 1}', "{broken", "", None]
    lake.create()
    places.load_locations(lake, spark.createDataFrame([(x,) for x in lines], "value string"))
    assert lake.table(names.LOCATIONS).count() == 1
    schema = StructType([StructField("response", StringType())])
    rejected = read_responses(spark, lake.bronze_locations, schema, "rejected").collect()
    assert sorted(r[0] or "" for r in rejected) == sorted(["[]", '{"results": 5}', "{broken", "", ""])
    weather = spark.createDataFrame(
        [("M", '{"latitude": "far", "longitude": 2.0}'), ("N", '{"latitude": 1.0}'), ("O", "7")], "marketName string, value string"
    )
    landed = {r["marketName"]: (r["latitude"], r["longitude"]) for r in land_weather(weather).collect()}
    assert landed == {"M": (None, 2.0), "N": (1.0, None)}
    bad = rejected_responses(weather, S.WEATHER_RESPONSE, tags=("marketName",)).collect()
    assert sorted(r["marketName"] for r in bad) == ["M", "O"]


def test_landing_counts_rows_by_file_date_after_the_write(lake, tmp_path, monkeypatch):
    def refused(*_):
        raise AssertionError("rows are not counted once per date while they are read")

    monkeypatch.setattr(daily, "Observation", refused)
    folder = tmp_path / "counted"
    write_day(folder, D1, price(D1, 1), price(D1, 1), price(D1, 2))
    write_day(folder, D2)
    write_day(folder, D4, price(D4, 3))
    lake.create()
    assert daily.ingest_prices(lake, str(folder), "2023-06-01 01:00:00") == 3
    log = lake.table(names.RUN_LOG).where("process_status = 'Completed'").collect()
    assert sorted((r["processed_file_table_date"], r["rows_read"], r["rows_written"]) for r in log) == [(D1, 3, 3), (D2, 0, 0), (D4, 1, 1)]
    assert daily.ingest_prices(lake, str(folder), "2023-06-01 02:00:00") == 0
