"""The queries of this package as SQL over the test tables."""

from __future__ import annotations

from granary import schemas as S

PRICING = """
pricing AS (
  SELECT CAST(o_orderdate AS DATE) AS date_of_pricing,
         l_orderkey * 10 + l_linenumber AS row_id,
         r_name AS state_name, n_name AS market_name,
         p_type AS productgroup_name, p_name AS product_name, p_brand AS variety,
         s_name AS origin,
         CAST(l_quantity AS DECIMAL(18,2)) AS arrival_in_tonnes,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(36,2)) AS minimum_price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2))
              * (CAST(1 AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(36,2)) AS maximum_price,
         CAST(l_extendedprice AS DECIMAL(36,2)) AS modal_price
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

RAW = """
raw AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%m/%d/%Y') END AS date_of_pricing,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS row_id,
         o_orderpriority AS state_name, l_linestatus AS market_name,
         p_type AS productgroup_name, p_name AS product_name, p_brand AS variety,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS origin,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)
           || CASE WHEN l_returnflag = 'R' THEN ' t' ELSE '' END AS arrival_in_tonnes,
         CASE WHEN l_discount > 0 THEN CAST(four AS VARCHAR) END AS minimum_price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + four AS VARCHAR) AS maximum_price,
         '-' || CAST(four AS VARCHAR) AS modal_price,
         l_shipdate AS source_file_load_date
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS four
        FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey)"""

_DATE = """CASE WHEN regexp_full_match(date_of_pricing, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
              THEN CAST(try_strptime(date_of_pricing, '%m/%d/%Y') AS DATE) END"""

RUNS = """
runs AS (
  SELECT event_type AS process_name, CAST(ts AS DATE) AS day, ts,
         value > {above} AS completed
  FROM events)"""

NUMBERED = """
dim_{name} AS (
  SELECT row_number() OVER (ORDER BY {col}) AS {id}, {col}
  FROM (SELECT DISTINCT {col} FROM pricing WHERE {col} IS NOT NULL))"""

DIM_STATE = NUMBERED.format(name="state", col="state_name", id="state_id")
DIM_MARKET = NUMBERED.format(name="market", col="market_name", id="market_id")
DIM_VARIETY = NUMBERED.format(name="variety", col="variety", id="variety_id")
DIM_PRODUCT = """
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_name, productgroup_name) AS product_id,
         productgroup_name, product_name
  FROM (SELECT DISTINCT product_name, productgroup_name FROM pricing WHERE product_name IS NOT NULL))"""
DIM_DATE_1997 = """
dim_date AS (
  SELECT row_number() OVER (ORDER BY d) AS date_id, strftime(d, '%d/%m/%Y') AS calendar_date
  FROM (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1997-12-31', INTERVAL 1 DAY)) AS d))"""

FACT = """
SELECT date_id, state_id, market_id, product_id, variety_id, row_id,
       arrival_in_tonnes, maximum_price, minimum_price, modal_price
FROM pricing p
LEFT JOIN dim_date d ON strftime(p.date_of_pricing, '%d/%m/%Y') = d.calendar_date
LEFT JOIN dim_state s ON p.state_name = s.state_name
LEFT JOIN dim_market m ON p.market_name = m.market_name
LEFT JOIN dim_product pr ON p.product_name = pr.product_name
                        AND p.productgroup_name = pr.productgroup_name
LEFT JOIN dim_variety v ON p.variety = v.variety
"""

LOCATED = """
located AS (
  SELECT c_custkey // 10 AS reply, c_custkey, c_acctbal, n_name, c_name,
         CASE WHEN c_acctbal > 0 THEN r_name END AS admin1,
         CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS admin2
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

LOCATIONS = """
SELECT admin1 AS "stateName", admin2 AS "districtName", c_name AS "countryName",
       c_custkey / 8 AS latitude, c_acctbal AS longitude, n_name AS "marketName",
       c_custkey AS population
FROM located"""

WEATHER = """
weather AS (
  SELECT n_name, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS y,
         max(o_totalprice) AS top, min(o_totalprice) AS low, count(*) AS n
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)"""

WEATHER_ROWS = """
SELECT n_name AS "marketName", y / 4 AS latitude, y / 8 AS longitude,
       CAST(day AS VARCHAR) AS "weatherDate", top AS "maximumTemparature",
       '°C' AS "unitOfTemparature", low AS "minimumTemparature",
       CASE WHEN n > 1 THEN CAST(n AS DOUBLE) END AS "rainFall", 'mm' AS "unitOfRainFall"
FROM weather"""

_HISTORY = """product_sk, product_id, productgroup_name, product_name, is_current,
       start_on, end_on, updated_on"""

_FIRST = "DATE '2024-01-01'"
_SECOND = "DATE '2024-02-01'"

_TEXT = """strftime(date_of_pricing, '%m/%d/%Y') AS "DATE_OF_PRICING",
       CAST(row_id AS VARCHAR) AS "ROW_ID", state_name AS "STATE_NAME",
       market_name AS "MARKET_NAME", productgroup_name AS "PRODUCTGROUP_NAME",
       product_name AS "PRODUCT_NAME", variety AS "VARIETY", origin AS "ORIGIN",
       CAST(arrival_in_tonnes AS VARCHAR) AS "ARRIVAL_IN_TONNES",
       CAST(minimum_price AS VARCHAR) AS "MINIMUM_PRICE",
       CAST(maximum_price AS VARCHAR) AS "MAXIMUM_PRICE",
       CAST(modal_price AS VARCHAR) AS "MODAL_PRICE",
       CAST(date_trunc('month', date_of_pricing) AS DATE) AS file_date"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _dim(cte: str, id_col: str, name_col: str, name: str) -> str:
    return _with(PRICING, cte) + f"SELECT {id_col}, {name_col} FROM dim_{name}"


def _newer(start: str) -> str:
    return _with(RUNS.format(above=150)) + f"""
SELECT event_id, event_type, ts FROM events
WHERE ts > (SELECT coalesce(max({start}), TIMESTAMP '1900-01-01')
            FROM runs WHERE process_name = 'purchase' AND completed)"""


def oracle_sql() -> dict[str, str]:
    return {
        "clean_daily_pricing": _with(RAW) + f"""
SELECT {_DATE} AS date_of_pricing, CAST(row_id AS BIGINT) AS row_id,
       state_name, market_name, productgroup_name, product_name, variety, origin,
       TRY_CAST(arrival_in_tonnes AS DECIMAL(18,2)) AS arrival_in_tonnes,
       TRY_CAST(minimum_price AS DECIMAL(36,2)) AS minimum_price,
       TRY_CAST(maximum_price AS DECIMAL(36,2)) AS maximum_price,
       TRY_CAST(modal_price AS DECIMAL(36,2)) AS modal_price,
       source_file_load_date
FROM raw""",
        "clean_rejects": _with(RAW) + f"""
SELECT row_id AS "ROW_ID", date_of_pricing AS "DATE_OF_PRICING",
       arrival_in_tonnes AS "ARRIVAL_IN_TONNES",
       concat_ws(',', CASE WHEN bad_date THEN 'date_of_pricing' END,
                      CASE WHEN bad_amount THEN 'arrival_in_tonnes' END) AS rejected_columns
FROM (SELECT *, ({_DATE}) IS NULL AS bad_date,
             TRY_CAST(arrival_in_tonnes AS DECIMAL(18,2)) IS NULL AS bad_amount
      FROM raw)
WHERE bad_date OR bad_amount""",
        "next_file_date": _with(RUNS.format(above=5)) + """
SELECT coalesce(CAST(max(day) + 1 AS DATE), DATE '2023-01-01') AS next_file_date
FROM runs WHERE process_name = 'purchase' AND completed""",
        "incremental_rows": _newer("ts"),
        "incremental_rows_date_precision": _newer("CAST(day AS TIMESTAMP)"),
        "run_log_latest": _with(RUNS.format(above=150)) + f"""
SELECT CAST(max(ts) AS DATE) AS last_date, max(ts) AS last_watermark, count(*) AS completed_runs
FROM (SELECT ts FROM runs WHERE process_name = 'purchase' AND completed
      UNION ALL
      SELECT * FROM (SELECT max(ts) AS ts FROM ({_newer('ts')})) WHERE ts IS NOT NULL)""",
        "dense_ids_by_range": """
SELECT row_number() OVER (ORDER BY l_orderkey) + 1000 AS order_id, l_orderkey
FROM (SELECT DISTINCT l_orderkey FROM lineitem)""",
        "dim_state": _dim(DIM_STATE, "state_id", "state_name", "state"),
        "dim_market": _dim(DIM_MARKET, "market_id", "market_name", "market"),
        "dim_variety": _dim(DIM_VARIETY, "variety_id", "variety", "variety"),
        "dim_incremental_append": _with(PRICING, """
earlier AS (
  SELECT row_number() OVER (ORDER BY origin) AS variety_id, origin AS variety
  FROM (SELECT DISTINCT origin FROM pricing WHERE state_name = 'ASIA'))""") + """
SELECT variety_id, variety FROM earlier
UNION ALL
SELECT row_number() OVER (ORDER BY origin) + (SELECT coalesce(max(variety_id), 0) FROM earlier), origin
FROM (SELECT DISTINCT origin FROM pricing)
WHERE origin NOT IN (SELECT variety FROM earlier)""",
        "dim_date": """
SELECT row_number() OVER (ORDER BY d) AS date_id, strftime(d, '%d/%m/%Y') AS calendar_date
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                    INTERVAL 1 DAY)) AS d FROM orders)""",
        "dim_product_first_load": _with(PRICING, DIM_PRODUCT) + """
SELECT product_id, productgroup_name, product_name FROM dim_product""",
        "dim_product_merge": _with(PRICING, """
src AS (SELECT product_name, min(productgroup_name) AS g FROM pricing GROUP BY 1)""", """
dim AS (
  SELECT row_number() OVER (ORDER BY product_name) AS product_id, product_name, g
  FROM (SELECT product_name, min(productgroup_name) AS g FROM pricing
        WHERE variety = 'Brand#1' GROUP BY 1))""") + f"""
SELECT product_id, src.g AS productgroup_name, dim.product_name, {_FIRST} AS created_on,
       CASE WHEN src.g <> dim.g THEN {_SECOND} ELSE {_FIRST} END AS updated_on
FROM dim JOIN src USING (product_name)
UNION ALL
SELECT row_number() OVER (ORDER BY product_name) + (SELECT coalesce(max(product_id), 0) FROM dim), g, product_name,
       {_SECOND}, {_SECOND}
FROM src WHERE product_name NOT IN (SELECT product_name FROM dim)""",
        "scd2_first_load": _with(PRICING, DIM_PRODUCT) + f"""
SELECT product_id AS product_sk, product_id, productgroup_name, product_name, true AS is_current,
       {_FIRST} AS start_on, CAST(NULL AS DATE) AS end_on, {_FIRST} AS updated_on
FROM dim_product""",
        "scd2_rerun_noop": _with(PRICING, DIM_PRODUCT) + f"""
SELECT product_id AS product_sk, product_id, productgroup_name, product_name, true AS is_current,
       {_FIRST} AS start_on, CAST(NULL AS DATE) AS end_on, {_FIRST} AS updated_on
FROM dim_product""",
        "scd2_change": _with(PRICING, DIM_PRODUCT, """
hist AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM dim_product
  WHERE product_name < 's')""", """
src AS (
  SELECT product_id, product_name,
         CASE WHEN productgroup_name = 'LARGE' THEN 'BULK' ELSE productgroup_name END AS productgroup_name
  FROM dim_product)""") + f"""
SELECT product_sk, product_id, productgroup_name, product_name,
       productgroup_name <> 'LARGE' AS is_current, {_FIRST} AS start_on,
       CASE WHEN productgroup_name = 'LARGE' THEN {_SECOND} END AS end_on,
       CASE WHEN productgroup_name = 'LARGE' THEN {_SECOND} ELSE {_FIRST} END AS updated_on
FROM hist
UNION ALL
SELECT row_number() OVER (ORDER BY product_id) + (SELECT max(product_sk) FROM hist),
       product_id, productgroup_name, product_name, true, {_SECOND}, NULL, {_SECOND}
FROM src
WHERE NOT EXISTS (SELECT 1 FROM hist WHERE hist.product_id = src.product_id
                  AND hist.productgroup_name = src.productgroup_name)""",
        "scd2_null_group": _with(PRICING, DIM_PRODUCT) + f"""
SELECT product_id AS product_sk, product_id, productgroup_name, product_name,
       productgroup_name <> 'PROMO' AS is_current, {_FIRST} AS start_on,
       CASE WHEN productgroup_name = 'PROMO' THEN {_SECOND} END AS end_on,
       CASE WHEN productgroup_name = 'PROMO' THEN {_SECOND} ELSE {_FIRST} END AS updated_on
FROM dim_product
UNION ALL
SELECT row_number() OVER (ORDER BY product_id) + (SELECT max(product_id) FROM dim_product),
       product_id, NULL, product_name, true, {_SECOND}, NULL, {_SECOND}
FROM dim_product WHERE productgroup_name = 'PROMO'""",
        "fact_min_slice": _with(PRICING, DIM_STATE, DIM_DATE_1997) + """
SELECT row_id, state_id, date_id, modal_price
FROM pricing p
LEFT JOIN dim_state s ON p.state_name = s.state_name
LEFT JOIN dim_date d ON strftime(p.date_of_pricing, '%d/%m/%Y') = d.calendar_date""",
        "fact_daily_pricing": _with(
            PRICING, DIM_DATE_1997, DIM_STATE, DIM_MARKET, DIM_PRODUCT, DIM_VARIETY
        ) + FACT,
        "fact_incremental": _with(
            PRICING, DIM_DATE_1997, DIM_STATE, DIM_MARKET, DIM_PRODUCT, DIM_VARIETY
        ) + FACT + """
WHERE p.date_of_pricing > (SELECT max(date_of_pricing) FROM pricing
                           WHERE date_of_pricing < DATE '2000-01-01')""",
        "flatten_locations": _with(LOCATED) + LOCATIONS,
        "json_roundtrip": _with(LOCATED) + LOCATIONS,
        "locations_filter_present": _with(LOCATED) + """
SELECT reply, count(*) AS n_results FROM located GROUP BY reply HAVING min(c_acctbal) >= 0""",
        "flatten_weather": _with(WEATHER) + WEATHER_ROWS,
        "land_weather_lines": _with(WEATHER) + WEATHER_ROWS + """
WHERE y NOT IN (1996, 1997)""",
        "weather_length_mismatch": _with(WEATHER) + """
SELECT n_name AS "marketName", y / 4 AS latitude, count(*) FILTER (n > 1) AS rain_days
FROM weather GROUP BY n_name, y HAVING count(*) FILTER (n > 1) < count(*)""",
        "struct_fields": _with(LOCATED) + """
SELECT reply, string_agg(coalesce(admin1, '?'), ',' ORDER BY c_custkey) AS states,
       string_agg(n_name, ',' ORDER BY c_custkey) AS markets
FROM located GROUP BY reply""",
        "explode_cross_limit": _with(LOCATED) + """
SELECT reply, name, longitude, latitude, population, row_number() OVER (ORDER BY reply, i, j, k, l) - 1 AS "sequenceId"
FROM (SELECT a.reply, a.n_name AS name, b.c_acctbal AS longitude, c.c_custkey / 8 AS latitude,
             d.c_custkey AS population,
             a.c_custkey AS i, b.c_custkey AS j, c.c_custkey AS k, d.c_custkey AS l
      FROM located a JOIN located b USING (reply) JOIN located c USING (reply) JOIN located d USING (reply)
      ORDER BY a.reply, i, j, k, l LIMIT 2000)""",
        "price_weather_report": _with(PRICING, WEATHER, """
geo AS (
  SELECT state, n_name, min(c_acctbal) AS low, max(c_acctbal) AS top, count(*) AS customers
  FROM (SELECT unnest([r_name, c_mktsegment]) AS state, n_name, c_acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  GROUP BY ALL)""") + """
SELECT DISTINCT p.*, g.low AS "MARKET_LATITUDE", g.top AS "MARKET_LONGITUDE",
       g.customers AS "MARKET_POPULATION",
       CASE WHEN w.day IS NOT NULL THEN '°C' END AS "TEMPARATURE_UNIT",
       w.top AS "MARKET_MAX_TEMPARATURE", w.low AS "MARKET_MIN_TEMPARATURE",
       CASE WHEN w.day IS NOT NULL THEN 'mm' END AS "RAINFALL_UNIT",
       CASE WHEN w.n > 1 THEN CAST(w.n AS DOUBLE) END AS "MARKET_DAILY_RAINFALL"
FROM pricing p
FULL JOIN (SELECT * FROM geo WHERE n_name <> 'NATION_7') g ON p.state_name = g.state AND p.market_name = g.n_name
FULL JOIN (SELECT * FROM weather WHERE n_name <> 'NATION_7') w ON w.n_name = p.market_name AND p.date_of_pricing = w.day""",
        "scd2_many_loads": _with(PRICING, DIM_PRODUCT, """
loads AS (
  SELECT product_id, product_name, productgroup_name, DATE '2024-01-01' AS load FROM dim_product WHERE product_name < 's'
  UNION ALL SELECT product_id, product_name, CASE WHEN productgroup_name = 'LARGE' THEN 'BULK' ELSE productgroup_name END, DATE '2024-02-01' FROM dim_product
  UNION ALL SELECT product_id, product_name, CASE WHEN productgroup_name <> 'PROMO' THEN productgroup_name END, DATE '2024-03-01' FROM dim_product
  UNION ALL SELECT product_id, product_name, productgroup_name, DATE '2024-04-01' FROM dim_product WHERE product_id % 3 > 0)""", """
changes AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY load) AS n,
           lag(productgroup_name) OVER (PARTITION BY product_id ORDER BY load) AS before FROM loads)
  WHERE n = 1 OR productgroup_name IS DISTINCT FROM before)""") + """
SELECT row_number() OVER (ORDER BY load, product_id) AS product_sk, product_id, productgroup_name, product_name,
       lead(load) OVER (PARTITION BY product_id ORDER BY load) IS NULL AS is_current, load AS start_on,
       lead(load) OVER (PARTITION BY product_id ORDER BY load) AS end_on
FROM changes""",
        "rejected_responses": _with(WEATHER) + """
SELECT n_name AS "marketName", CASE y WHEN 1996 THEN '[' ELSE '{' END AS first_letter, count(DISTINCT y) AS responses
FROM weather WHERE y IN (1996, 1997) GROUP BY n_name, y""",
        "unstamped_rows": _with(RAW) + """
SELECT CASE WHEN row_id LIKE '%7' THEN 'no stamp' ELSE 'taken' END AS outcome, count(*) AS rows
FROM raw WHERE row_id LIKE '%7' OR source_file_load_date > TIMESTAMP '1998-01-01' GROUP BY 1""",
        "fact_after_skipped_run": _with(PRICING, """
named AS (
  SELECT row_id, product_name || '/' || productgroup_name AS name, productgroup_name AS grp, year(date_of_pricing) = 1996 AS later FROM pricing)""", """
ids AS (
  SELECT name, row_number() OVER (ORDER BY bool_and(later), name) AS product_id, any_value(grp) || CASE WHEN bool_or(later) THEN ' II' ELSE '' END AS grp
  FROM named GROUP BY name)""") + """
SELECT row_id, product_id, name AS product_name, ids.grp AS productgroup_name FROM named JOIN ids USING (name)""",
        "step_counts": _with(PRICING) + f"""
SELECT '{S.PROCESS_INGEST}' AS process_name, count(DISTINCT date_trunc('month', date_of_pricing)) AS runs, count(*) AS rows_read,
       count(*) AS rows_written, CAST(NULL AS BIGINT) AS rows_rejected FROM pricing
UNION ALL SELECT '{S.PROCESS_SILVER}', 2, count(*), count(*), count(*) FILTER (row_id % 10 = 3) FROM pricing
UNION ALL SELECT '{S.PROCESS_FACT}', 2, count(*), count(*), NULL FROM pricing""",
        "late_files": _with(PRICING) + """
SELECT CAST(date_trunc('month', date_of_pricing) + INTERVAL 30 YEAR AS DATE) AS file_date, count(*) AS rows
FROM pricing GROUP BY 1""",
        "daily_rejects": _with(PRICING) + """
SELECT row_id, CAST(arrival_in_tonnes AS VARCHAR) || ' t' AS "ARRIVAL_IN_TONNES", 'arrival_in_tonnes' AS rejected
FROM pricing WHERE row_id % 10 = 3""",
        "daily_star_facts": _with(PRICING) + """
SELECT row_id, strftime(date_of_pricing, '%d/%m/%Y') AS calendar_date, state_name, market_name, product_name,
       productgroup_name, variety, CASE WHEN row_id % 10 <> 3 THEN arrival_in_tonnes END AS arrival_in_tonnes,
       minimum_price, maximum_price, modal_price
FROM pricing""",
        "stream_daily_load": _with(PRICING) + """
SELECT row_id, strftime(date_of_pricing, '%d/%m/%Y') AS calendar_date, state_name, market_name, product_name,
       productgroup_name, variety, CASE WHEN row_id % 10 <> 3 THEN arrival_in_tonnes END AS arrival_in_tonnes,
       minimum_price, maximum_price, modal_price
FROM pricing""",
        "csv_landing_union": _with(PRICING) + f"""
SELECT {_TEXT}, CASE WHEN year(date_of_pricing) >= 1998 THEN substr(variety, 7, 2) END AS "GRADE"
FROM pricing""",
        "stream_available_now": _with(PRICING) + f"SELECT {_TEXT} FROM pricing",
        "evolving_append": """
SELECT o_orderkey, o_orderdate,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
        "partitioned_append": """
SELECT *, CAST(ts AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
        "reference_copy": """
SELECT *, (SELECT count(*) FROM part) AS rows_written, unnest(['parquet', 'json']) AS form FROM part""",
        "json_table": "SELECT * FROM customer",
        "append_by_name": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
        "overwrite_partitions": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END * o_totalprice AS o_totalprice, o_orderstatus FROM orders""",
        "replace_managed_table": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
        "publish_version": "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 3 AS o_orderdate FROM orders",
        "fixture_rows": """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey,
       unnest(['csv', 'json']) AS fixture
FROM nation""",
        "log_entries": f"""
SELECT '{S.PROCESS_INGEST}' AS process_name, day, unnest(['{S.STATUS_FAILED}', '{S.STATUS_COMPLETED}']) AS process_status
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
        "load_stamps": "SELECT true AS current, count(*) AS rows, CAST(1 AS BIGINT) AS stamps FROM lineitem",
        "price_file_names": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, 'PW_MW_DR_%m%d%Y.csv') AS file,
       CAST(o_orderdate AS DATE) AS parsed
FROM orders""",
        "request_urls": _with(LOCATED) + f"""
SELECT latitude, longitude, "marketName",
       'https://archive-api.open-meteo.com/v1/archive?latitude=' || CAST(latitude AS VARCHAR)
       || '&longitude=' || CAST(longitude AS VARCHAR)
       || '&start_date=2023-01-01&end_date=2024-01-01'
       || '&daily=temperature_2m_max,temperature_2m_min,rain_sum' AS url
FROM ({LOCATIONS})""",
        "limit_ordered": _with(PRICING) + """
SELECT product_name AS "marketName",
       'https://geocoding-api.open-meteo.com/v1/search?name=' || replace(product_name, ' ', '%20')
       || '&count=10&language=en&format=json' AS url
FROM (SELECT DISTINCT product_name FROM pricing) ORDER BY product_name LIMIT 10""",
        "distinct_rows": _with(PRICING) + "SELECT DISTINCT product_name, productgroup_name FROM pricing",
        "union_all": """
SELECT c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_name, s_acctbal FROM supplier""",
        "anti_join": """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE 2 * o_custkey = c_custkey)""",
        "full_join": """
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name
FROM orders FULL JOIN (SELECT 2 * c_custkey AS c_custkey, c_name FROM customer) ON o_custkey = c_custkey""",
        "left_star_lookup": """
SELECT CAST(l_suppkey AS VARCHAR) AS key, l_orderkey, l_quantity, s_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = 2 * s_suppkey""",
        "coalesce_max": """
SELECT count(*) AS orders, coalesce(max(o_orderkey), 0) AS filled_max,
       coalesce(max(o_orderkey) FILTER (o_totalprice < 0), 0) AS empty_max
FROM orders""",
    }
