"""DuckDB statements equal to each registered query, over the supplied tables.

DuckDB sees only the raw tables, so every statement starts with the same
CTE chain: the adapter (FIXTURES.md part 2) -> bronze -> silver -> star.
Types are pinned on both sides: year/month/day/hour int, counts bigint, money
sums decimal(28,2), ratios and means double rounded to 6 places; ties are
broken by the group key and NULL sorts as the largest value.
"""

from __future__ import annotations

from tripmart.config import PAYMENT_TYPES, TESTDATA, VENDORS, Settings


def _values(rows: dict, key: str, name: str) -> str:
    body = " UNION ALL ".join(f"SELECT {k} AS {key}, '{v}' AS {name}" if i == 0
                              else f"SELECT {k}, '{v}'"
                              for i, (k, v) in enumerate(sorted(rows.items())))
    return body


def prefix(s: Settings = TESTDATA) -> str:
    money = "DECIMAL(10,2)"
    return f"""WITH
_nsup AS (SELECT count(*) AS n FROM supplier),
_li AS (
  SELECT l.*,
    CASE WHEN l_linenumber % 3 = 0 THEN 'green' ELSE 'yellow' END AS service_type,
    strftime(l_shipdate, '%Y-%m') AS source_month,
    CAST(l_shipdate AS TIMESTAMP)
      + to_minutes(CAST((l_orderkey * 7 + l_linenumber * 131) % 1440 AS BIGINT)) AS _base
  FROM lineitem l
),
bronze_all AS (
  SELECT
    CAST(CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE l_linenumber % 4 END AS BIGINT) AS vendorid,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE _base END AS pickup_datetime,
    _base + to_minutes(CAST(CAST(l_quantity AS INTEGER) - 2 AS BIGINT))
          + to_seconds(CAST(l_partkey % 60 AS BIGINT)) AS dropoff_datetime,
    CAST(CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_orderkey % 6 AS DOUBLE) END AS BIGINT)
      AS passenger_count,
    (l_partkey % 100) / 4.0 - 1.0 AS trip_distance,
    CAST(l_suppkey AS BIGINT) AS pulocationid,
    CAST(l_partkey % (SELECT n FROM _nsup) AS BIGINT) AS dolocationid,
    CAST(CAST(l_orderkey % 6 + 1 AS DOUBLE) AS BIGINT) AS ratecodeid,
    CAST(CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 7 END AS BIGINT) AS payment_type,
    CASE WHEN l_partkey % 50 = 0 THEN CAST(0.0 AS DOUBLE) ELSE l_extendedprice END AS fare_amount,
    l_discount * 100 AS tip_amount,
    l_tax * 100 AS tolls_amount,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice ELSE l_extendedprice END
      + l_discount * 100 + l_tax * 100 AS total_amount,
    source_month, service_type
  FROM _li
),
bronze_zones AS (
  SELECT CAST(s_suppkey AS BIGINT) AS locationid,
    CASE WHEN s_suppkey % 29 = 7 THEN NULL ELSE r_name END AS borough,
    s_name AS _zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 13 <> 5
),
silver_all AS (
  SELECT service_type, source_month,
    CAST(vendorid AS INTEGER) AS vendor_id,
    CAST(pickup_datetime AS TIMESTAMP) AS pickup_ts,
    CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
    CAST(passenger_count AS INTEGER) AS passengers_count,
    CAST(trip_distance AS {money}) AS trip_distance,
    CAST(pulocationid AS INTEGER) AS pickup_location_id,
    CAST(dolocationid AS INTEGER) AS dropoff_location_id,
    CAST(ratecodeid AS INTEGER) AS rate_code_id,
    CAST(payment_type AS INTEGER) AS payment_type,
    CAST(fare_amount AS {money}) AS fare_amount,
    CAST(tip_amount AS {money}) AS tip_amount,
    CAST(tolls_amount AS {money}) AS tolls_amount,
    CAST(total_amount AS {money}) AS total_amount
  FROM bronze_all
),
zone_names AS (SELECT CAST(locationid AS INTEGER) AS location_id, _zone AS zone_name FROM bronze_zones),
silver AS (
  SELECT t.*, zp.zone_name AS pickup_location_name, zd.zone_name AS dropoff_location_name
  FROM silver_all t
  JOIN zone_names zp ON t.pickup_location_id = zp.location_id
  JOIN zone_names zd ON t.dropoff_location_id = zd.location_id
  WHERE t.pickup_ts IS NOT NULL AND t.dropoff_ts IS NOT NULL AND t.pickup_ts <= t.dropoff_ts
    AND t.trip_distance >= 0 AND t.total_amount >= 0
),
fct AS (
  SELECT
    md5(concat(service_type, CAST(pickup_ts AS VARCHAR), CAST(dropoff_ts AS VARCHAR),
               CAST(pickup_location_id AS VARCHAR), CAST(dropoff_location_id AS VARCHAR))) AS trip_key,
    CAST(strftime(pickup_ts, '%Y%m%d') AS INTEGER) AS pickup_date_key,
    CAST(pickup_ts AS DATE) AS pickup_date,
    pickup_location_id AS pu_zone_key,
    dropoff_location_id AS do_zone_key,
    CAST(CASE WHEN service_type = 'yellow' THEN 1 ELSE 2 END AS INTEGER) AS service_key,
    CAST(CASE WHEN payment_type = 1 THEN 1 WHEN payment_type = 2 THEN 2 ELSE 3 END AS INTEGER)
      AS payment_type_key,
    CAST(CASE WHEN vendor_id = 1 THEN 1 WHEN vendor_id = 2 THEN 2 ELSE 3 END AS INTEGER) AS vendor_key,
    pickup_ts, dropoff_ts, passengers_count, trip_distance,
    fare_amount, tip_amount, tolls_amount, total_amount
  FROM silver
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week
  FROM (SELECT unnest(generate_series(DATE '{s.calendar_start}', DATE '{s.calendar_end}',
                                      INTERVAL 1 DAY)) AS d)
),
dim_zone AS (
  SELECT CAST(locationid AS INTEGER) AS zone_key, CAST(locationid AS INTEGER) AS location_id,
    _zone AS zone_name, borough FROM bronze_zones
),
dim_service_type AS (SELECT CAST(1 AS INTEGER) AS service_id, 'yellow' AS service_type
                     UNION ALL SELECT 2, 'green'),
dim_payment_type AS ({_values(PAYMENT_TYPES, "payment_type_key", "payment_type")}),
dim_vendor AS ({_values(VENDORS, "vendor_key", "vendor_name")}),
_minutes AS (
  SELECT f.*, CAST(date_diff('microsecond', pickup_ts, dropoff_ts) AS DOUBLE) / 60000000.0 AS minutes,
    CAST(date_diff('microsecond', pickup_ts, dropoff_ts) AS DOUBLE) / 3600000000.0 AS hours
  FROM fct f
)
"""


TIP = ("ROUND(AVG(CAST(f.tip_amount AS DOUBLE) / NULLIF(CAST(f.fare_amount AS DOUBLE), 0)) * 100, 6)")
REV = "CAST(SUM(f.total_amount) AS DECIMAL(28,2))"
DATED = "fct f JOIN dim_date d ON f.pickup_date_key = d.date_key"


def questions(s: Settings = TESTDATA) -> dict[str, str]:
    y, n, k, m = s.focus_year, s.top_n, s.top_per_group, s.min_trips
    classes = ", ".join(f"'{x}'" for x in s.payment_classes)
    return {
        "q01_trips_by_month": f"""
SELECT d.month, COUNT(*) AS total_trips FROM {DATED} WHERE d.year = {y} GROUP BY d.month""",
        "q02_trips_by_service_month": f"""
SELECT d.year, d.month, s.service_type, COUNT(*) AS total_trips
FROM {DATED} JOIN dim_service_type s ON f.service_key = s.service_id
GROUP BY d.year, d.month, s.service_type""",
        "q03_top_pickup_zones": f"""
SELECT z.zone_name, COUNT(*) AS total_trips
FROM {DATED} JOIN dim_zone z ON f.pu_zone_key = z.zone_key WHERE d.year = {y}
GROUP BY z.zone_name ORDER BY total_trips DESC NULLS FIRST, z.zone_name ASC NULLS LAST LIMIT {n}""",
        "q04_top_dropoff_zones": f"""
SELECT z.zone_name, COUNT(*) AS total_trips
FROM {DATED} JOIN dim_zone z ON f.do_zone_key = z.zone_key WHERE d.year = {y}
GROUP BY z.zone_name ORDER BY total_trips DESC NULLS FIRST, z.zone_name ASC NULLS LAST LIMIT {n}""",
        "q05_top_boroughs_by_month": f"""
SELECT year, month, borough, trips FROM (
  SELECT d.year, d.month, z.borough, COUNT(*) AS trips,
    ROW_NUMBER() OVER (PARTITION BY d.year, d.month
                       ORDER BY COUNT(*) DESC NULLS FIRST, z.borough ASC NULLS LAST) AS rn
  FROM {DATED} JOIN dim_zone z ON f.pu_zone_key = z.zone_key
  GROUP BY d.year, d.month, z.borough) WHERE rn <= {k}""",
        "q06_peak_hours_by_weekday": f"""
SELECT day_of_week, hour_of_day, trips FROM (
  SELECT d.day_of_week, CAST(hour(f.pickup_ts) AS INTEGER) AS hour_of_day, COUNT(*) AS trips,
    ROW_NUMBER() OVER (PARTITION BY d.day_of_week
                       ORDER BY COUNT(*) DESC NULLS FIRST, CAST(hour(f.pickup_ts) AS INTEGER)) AS rn
  FROM {DATED} GROUP BY d.day_of_week, CAST(hour(f.pickup_ts) AS INTEGER)) WHERE rn <= {k}""",
        "q07_trips_by_weekday": f"""
SELECT d.day_of_week, COUNT(*) AS total_trips FROM {DATED} GROUP BY d.day_of_week""",
        "q08_revenue_by_month": f"""
SELECT d.year, d.month, {REV} AS total_revenue FROM {DATED} GROUP BY d.year, d.month""",
        "q09_revenue_by_service_month": f"""
SELECT d.year, d.month, s.service_type, {REV} AS total_revenue
FROM {DATED} JOIN dim_service_type s ON f.service_key = s.service_id
GROUP BY d.year, d.month, s.service_type""",
        "q10_tip_pct_by_month": f"""
SELECT d.year, d.month, {TIP} AS avg_tip_percentage FROM {DATED} GROUP BY d.year, d.month""",
        "q11_tip_pct_by_borough_month": f"""
SELECT d.year, d.month, z.borough, {TIP} AS avg_tip_percentage
FROM {DATED} JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY d.year, d.month, z.borough""",
        "q12_top_zones_by_revenue": f"""
SELECT z.zone_name, {REV} AS total_revenue
FROM fct f JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY z.zone_name
ORDER BY total_revenue DESC NULLS FIRST, z.zone_name ASC NULLS LAST LIMIT {n}""",
        "q13_top_zones_by_tip_pct": f"""
SELECT z.zone_name, COUNT(*) AS total_trips, {TIP} AS avg_tip_pct
FROM fct f JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY z.zone_name
HAVING COUNT(*) >= {m}
ORDER BY AVG(CAST(f.tip_amount AS DOUBLE) / NULLIF(CAST(f.fare_amount AS DOUBLE), 0)) DESC NULLS FIRST,
  z.zone_name ASC NULLS LAST LIMIT {n}""",
        "q14_cash_vs_card": f"""
SELECT p.payment_type, COUNT(*) AS total_trips, {REV} AS total_revenue, {TIP} AS avg_tip_pct
FROM fct f JOIN dim_payment_type p ON f.payment_type_key = p.payment_type_key
WHERE p.payment_type IN ({classes}) GROUP BY p.payment_type""",
        "q15_avg_duration_by_month": """
SELECT d.year, d.month, ROUND(AVG(f.minutes), 6) AS avg_duration_min
FROM _minutes f JOIN dim_date d ON f.pickup_date_key = d.date_key GROUP BY d.year, d.month""",
        "q16_avg_distance_by_month": f"""
SELECT d.year, d.month, ROUND(AVG(CAST(f.trip_distance AS DOUBLE)), 6) AS avg_distance
FROM {DATED} GROUP BY d.year, d.month""",
        "q17_speed_by_borough_hour": """
SELECT z.borough, CAST(hour(f.pickup_ts) AS INTEGER) AS hour_of_day,
  ROUND(AVG(CAST(f.trip_distance AS DOUBLE) / NULLIF(f.hours, 0)), 6) AS avg_speed_mph
FROM _minutes f JOIN dim_zone z ON f.pu_zone_key = z.zone_key
GROUP BY z.borough, CAST(hour(f.pickup_ts) AS INTEGER)""",
        "q18_duration_percentiles": """
SELECT z.borough,
  ROUND(quantile_cont(f.minutes, 0.5), 6) AS p50_duration_min,
  ROUND(quantile_cont(f.minutes, 0.9), 6) AS p90_duration_min
FROM _minutes f JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY z.borough""",
        "q19_top_zones_by_p90": f"""
SELECT z.zone_name, ROUND(quantile_cont(f.minutes, 0.9), 6) AS p90_duration_min
FROM _minutes f JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY z.zone_name
ORDER BY quantile_cont(f.minutes, 0.9) DESC NULLS FIRST, z.zone_name ASC NULLS LAST LIMIT {n}""",
        "q20_top_routes": f"""
SELECT puz.borough AS pickup_borough, doz.borough AS dropoff_borough, COUNT(*) AS total_trips
FROM fct f JOIN dim_zone puz ON f.pu_zone_key = puz.zone_key
JOIN dim_zone doz ON f.do_zone_key = doz.zone_key
GROUP BY puz.borough, doz.borough
ORDER BY total_trips DESC NULLS FIRST, pickup_borough ASC NULLS LAST, dropoff_borough ASC NULLS LAST
LIMIT {n}""",
    }


def statements(s: Settings = TESTDATA) -> dict[str, str]:
    """Full statements (prefix + body) for every key with an oracle."""
    head = prefix(s)
    bodies = dict(questions(s))
    from tripmart.plans import oracle_layers
    bodies.update(oracle_layers.bodies(s))
    again = head.replace("bronze_all AS (", "bronze_delivered AS (", 1).replace(
        "bronze_zones AS (", f"bronze_all AS ({oracle_layers.REDELIVERED}),\nbronze_zones AS (", 1)
    return {k: (again if k == "refresh_changed_month" else head) + v.strip() for k, v in bodies.items()}
