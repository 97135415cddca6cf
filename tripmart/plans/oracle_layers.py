"""DuckDB bodies for the non-question keys (layers, loads, checks, imputation).

Each body follows the shared CTE prefix of ``plans.oracle``.
"""

from __future__ import annotations

from tripmart.config import TESTDATA, Settings

BRONZE_NUMBERS = ("vendorid", "passenger_count", "pulocationid", "dolocationid",
                  "ratecodeid", "payment_type")
NUMERIC_FACT = ("passengers_count", "trip_distance", "fare_amount", "tip_amount",
                "tolls_amount", "total_amount")
REASONS = {
    "null_pickup_ts": "t.pickup_ts IS NULL",
    "null_dropoff_ts": "t.dropoff_ts IS NULL",
    "pickup_after_dropoff": "t.pickup_ts > t.dropoff_ts",
    "negative_or_null_distance": "COALESCE(t.trip_distance < 0, TRUE)",
    "negative_or_null_total": "COALESCE(t.total_amount < 0, TRUE)",
    "unknown_pickup_zone": "zp.location_id IS NULL",
    "unknown_dropoff_zone": "zd.location_id IS NULL",
}
KEPT = ("COALESCE(t.pickup_ts IS NOT NULL AND t.dropoff_ts IS NOT NULL "
        "AND t.pickup_ts <= t.dropoff_ts AND t.trip_distance >= 0 AND t.total_amount >= 0 "
        "AND zp.location_id IS NOT NULL AND zd.location_id IS NOT NULL, FALSE)")


def _plan(start: str, end: str) -> str:
    """Month starts on or after ``start`` up to ``end``, x services."""
    return f"""
SELECT CAST(year(ms) AS INTEGER) AS year, CAST(month(ms) AS INTEGER) AS month,
  strftime(ms, '%Y-%m') AS source_month, svc.service_type
FROM (SELECT CAST(unnest(generate_series(first_ms, end_d, INTERVAL 1 MONTH)) AS DATE) AS ms
      FROM (SELECT CASE WHEN day(s) = 1 THEN s
                        ELSE CAST(date_trunc('month', s) + INTERVAL 1 MONTH AS DATE) END AS first_ms,
                   e AS end_d
            FROM (SELECT {start} AS s, {end} AS e))
      WHERE first_ms <= end_d),
     (VALUES ('yellow'), ('green')) svc(service_type)"""


def _with_trips(dim: str, key: str, fact_key: str) -> str:
    return f"""
SELECT d.*, COALESCE(t.trips, 0) AS trips FROM {dim} d
LEFT JOIN (SELECT {fact_key} AS k, COUNT(*) AS trips FROM fct GROUP BY {fact_key}) t ON d.{key} = t.k"""


def _failures(model: str, check: str, column: str, count_sql: str) -> str:
    return (f"SELECT '{model}' AS model, '{check}' AS check_name, '{column}' AS column_name, "
            f"CAST(({count_sql}) AS BIGINT) AS failures")


def _suite() -> str:
    nn = "SELECT COUNT(*) FROM {m} WHERE {c} IS NULL"
    uq = ("SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {m} WHERE {c} IS NOT NULL "
          "GROUP BY {c} HAVING COUNT(*) > 1)")
    av = "SELECT COUNT(*) FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN ({v})"
    rel = ("SELECT COUNT(*) FROM {m} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
           "(SELECT 1 FROM {p} y WHERE y.{f} = x.{c})")
    rows = [
        ("silver_trips", "silver", "not_null", "pickup_ts", nn, {}),
        ("silver_trips", "silver", "not_null", "dropoff_ts", nn, {}),
        ("silver_trips", "silver", "relationships", "pickup_location_id", rel,
         {"p": "bronze_zones", "f": "locationid"}),
        ("silver_trips", "silver", "relationships", "dropoff_location_id", rel,
         {"p": "bronze_zones", "f": "locationid"}),
        ("dim_service_type", "dim_service_type", "accepted_values", "service_type", av,
         {"v": "'yellow', 'green'"}),
        ("dim_payment_type", "dim_payment_type", "accepted_values", "payment_type", av,
         {"v": "'cash', 'card', 'other/unknown'"}),
        ("dim_zone", "dim_zone", "unique", "zone_key", uq, {}),
        ("dim_zone", "dim_zone", "not_null", "zone_key", nn, {}),
        ("dim_date", "dim_date", "unique", "date_key", uq, {}),
        ("dim_date", "dim_date", "not_null", "date_key", nn, {}),
        ("fct_trips", "fct", "unique", "trip_key", uq, {}),
        ("fct_trips", "fct", "not_null", "trip_key", nn, {}),
        ("fct_trips", "fct", "relationships", "pu_zone_key", rel,
         {"p": "dim_zone", "f": "zone_key"}),
        ("fct_trips", "fct", "relationships", "do_zone_key", rel,
         {"p": "dim_zone", "f": "zone_key"}),
        ("fct_trips", "fct", "relationships", "pickup_date_key", rel,
         {"p": "dim_date", "f": "date_key"}),
    ]
    parts = [_failures(model, check, col, tmpl.format(m=cte, c=col, **kw))
             for model, cte, check, col, tmpl, kw in rows]
    return "\nUNION ALL ".join(parts)


#: A month delivered again: what bronze holds in place of ``bronze_all`` (for refresh_changed_month).
REDELIVERED = """
  SELECT * REPLACE (
    CASE WHEN service_type = 'yellow' AND source_month = '1997-06' AND pulocationid % 5 = 1
         THEN pickup_datetime + INTERVAL 1 MONTH ELSE pickup_datetime END AS pickup_datetime,
    CASE WHEN service_type = 'yellow' AND source_month = '1997-06' AND pulocationid % 5 = 1
         THEN dropoff_datetime + INTERVAL 1 MONTH ELSE dropoff_datetime END AS dropoff_datetime)
  FROM bronze_delivered
  WHERE NOT (service_type = 'yellow' AND source_month = '1997-06' AND pulocationid % 5 = 0)
"""


def bodies(s: Settings = TESTDATA) -> dict[str, str]:
    lo = f"DATE '{s.calendar_start.replace(day=1)}'"
    hi_month = s.calendar_end.replace(day=1)
    hi = f"CAST(DATE '{hi_month}' + INTERVAL 1 MONTH AS DATE)"
    reasons = ",\n  ".join(f"COUNT(*) FILTER (WHERE {v}) AS {k}" for k, v in REASONS.items())
    unpivot = "\nUNION ALL ".join(f"SELECT '{k}' AS reason, {k} AS row_count FROM _flags"
                                  for k in list(REASONS) + ["rejected", "kept"])
    med = lambda col: f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {col} DESC)"
    return {
        "load_plan": _plan("CAST((SELECT min(l_shipdate) FROM lineitem) AS DATE)",
                           "CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE)"),
        "bronze_trips": """
SELECT vendorid,
  CASE WHEN service_type = 'yellow' THEN pickup_datetime END AS tpep_pickup_datetime,
  CASE WHEN service_type = 'yellow' THEN dropoff_datetime END AS tpep_dropoff_datetime,
  CASE WHEN service_type = 'green' THEN pickup_datetime END AS lpep_pickup_datetime,
  CASE WHEN service_type = 'green' THEN dropoff_datetime END AS lpep_dropoff_datetime,
  passenger_count, trip_distance, pulocationid, dolocationid, ratecodeid, payment_type,
  fare_amount, tip_amount, tolls_amount, total_amount, source_month, service_type
FROM bronze_all""",
        "bronze_int_repair": "SELECT service_type, COUNT(*) AS trips, " + ", ".join(
            f"COUNT({x}) AS {x}_n, CAST(SUM({x}) AS BIGINT) AS {x}_sum" for x in BRONZE_NUMBERS)
        + " FROM bronze_all GROUP BY service_type",
        "bronze_reload": """
SELECT service_type, source_month, COUNT(*) AS trips,
  CAST(SUM(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(28,2)) AS revenue
FROM bronze_all GROUP BY service_type, source_month""",
        "bronze_align": """
SELECT source_month, COUNT(*) AS trips,
  COUNT(CASE WHEN CAST(substr(source_month, 6, 2) AS INTEGER) % 2 = 1 THEN ratecodeid END) AS ratecodes,
  COUNT(passenger_count) AS passengers, 16 AS n_columns
FROM bronze_all WHERE service_type = 'yellow' GROUP BY source_month""",
        "landing_load": f"""
SELECT p.service_type, p.source_month, COALESCE(b.trips, 0) AS trips, COALESCE(b.ratecodes, 0) AS ratecodes,
  (SELECT COUNT(*) FROM bronze_all x WHERE x.service_type = p.service_type
     AND substr(x.source_month, 6, 2) <> '03') AS rows_loaded
FROM ({_plan(f"DATE '{s.plan_start}'", f"DATE '{s.plan_end}'")}) p
LEFT JOIN (
  SELECT service_type, source_month, COUNT(*) AS trips,
    COUNT(CASE WHEN CAST(substr(source_month, 6, 2) AS INTEGER) % 2 = 1 THEN ratecodeid END) AS ratecodes
  FROM bronze_all WHERE substr(source_month, 6, 2) <> '03' GROUP BY service_type, source_month) b
  ON p.service_type = b.service_type AND p.source_month = b.source_month""",
        "refresh_changed_month": """
SELECT m.*, CASE WHEN pickup_month IN (DATE '1997-06-01', DATE '1997-07-01') THEN trips ELSE 0 END AS rows_rewritten,
  CAST(SUM(CASE WHEN pickup_month IN (DATE '1997-06-01', DATE '1997-07-01') THEN trips ELSE 0 END) OVER () AS BIGINT)
    AS all_rewritten
FROM (SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month, COUNT(*) AS trips,
        CAST(SUM(total_amount) AS DECIMAL(28,2)) AS revenue FROM fct GROUP BY 1) m""",
        "load_ledger": f"""
SELECT p.source_month AS year_month, p.service_type,
  CASE WHEN l.trips IS NULL THEN 'missing' WHEN p.month = 4 THEN 'partial' WHEN p.month = 5 THEN 'stale'
    ELSE 'loaded' END AS status, COALESCE(l.trips, 0) AS rows_loaded
FROM ({_plan(f"DATE '{s.plan_start}'", f"DATE '{s.plan_end}'")}) p
LEFT JOIN (SELECT service_type, source_month, COUNT(*) AS trips FROM bronze_all
           WHERE substr(source_month, 6, 2) <> '03' GROUP BY service_type, source_month) l
  ON p.service_type = l.service_type AND p.source_month = l.source_month""",
        "fact_compaction": """
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month, COUNT(*) AS trips,
  CAST(SUM(total_amount) AS DECIMAL(28,2)) AS revenue, CAST(1 AS BIGINT) AS files
FROM fct GROUP BY 1""",
        "rollup_by_service_month": """
SELECT d.year, d.month, s.service_type, COUNT(*) AS total_trips,
  CAST(SUM(f.total_amount) AS DECIMAL(28,2)) AS total_revenue,
  ROUND(AVG(CAST(f.tip_amount AS DOUBLE) / NULLIF(CAST(f.fare_amount AS DOUBLE), 0)) * 100, 6) AS avg_tip_percentage,
  ROUND(AVG(f.minutes), 6) AS avg_duration_min, ROUND(AVG(CAST(f.trip_distance AS DOUBLE)), 6) AS avg_distance
FROM _minutes f JOIN dim_date d ON f.pickup_date_key = d.date_key JOIN dim_service_type s ON f.service_key = s.service_id
GROUP BY d.year, d.month, s.service_type""",
        "lookup_reload": "SELECT locationid, borough, _zone, 'static' AS source_month, 'lookup' AS service_type FROM bronze_zones",
        "gold_reload": "SELECT 'fct_trips' AS table_name, (SELECT COUNT(*) FROM fct) AS n" + "".join(
            f" UNION ALL SELECT '{t}', (SELECT COUNT(*) FROM {t})"
            for t in ("dim_date", "dim_zone", "dim_service_type", "dim_payment_type", "dim_vendor")),
        "zone_buckets": _with_trips("dim_zone", "zone_key", "pu_zone_key"),
        "zone_join_bucketed": """
SELECT z.zone_key, z.zone_name, z.borough, COUNT(*) AS trips, CAST(SUM(f.total_amount) AS DECIMAL(28,2)) AS revenue
FROM fct f JOIN dim_zone z ON f.pu_zone_key = z.zone_key GROUP BY z.zone_key, z.zone_name, z.borough""",
        "list_partitions": _with_trips("dim_service_type", "service_id", "service_key"),
        "stream_ingest": """
SELECT service_type, source_month, COUNT(*) AS trips,
  CAST(SUM(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(28,2)) AS revenue
FROM bronze_all GROUP BY service_type, source_month""",
        "coverage": f"""
SELECT p.source_month AS year_month, p.service_type,
  CASE WHEN l.source_month IS NOT NULL THEN 'loaded' ELSE 'missing' END AS status
FROM ({_plan(f"DATE '{s.plan_start}'", f"DATE '{s.plan_end}'")}) p
LEFT JOIN (SELECT DISTINCT service_type, source_month FROM bronze_all) l
  ON p.service_type = l.service_type AND p.source_month = l.source_month""",
        "silver_yellow": "SELECT * FROM silver_all WHERE service_type = 'yellow'",
        "silver_green": "SELECT * FROM silver_all WHERE service_type = 'green'",
        "silver_trips": "SELECT * FROM silver",
        "silver_rejects": f"""
, _flags AS (
  SELECT {reasons},
  COUNT(*) FILTER (WHERE NOT {KEPT}) AS rejected,
  COUNT(*) FILTER (WHERE {KEPT}) AS kept
  FROM silver_all t
  LEFT JOIN (SELECT DISTINCT location_id FROM zone_names) zp ON t.pickup_location_id = zp.location_id
  LEFT JOIN (SELECT DISTINCT location_id FROM zone_names) zd ON t.dropoff_location_id = zd.location_id)
{unpivot}""",
        "dim_zone": "SELECT * FROM dim_zone",
        "zone_lookup_csv": "SELECT * FROM dim_zone",
        "dim_date": _with_trips("dim_date", "date_key", "pickup_date_key"),
        "dim_service_type": _with_trips("dim_service_type", "service_id", "service_key"),
        "dim_payment_type": _with_trips("dim_payment_type", "payment_type_key", "payment_type_key"),
        "dim_vendor": _with_trips("dim_vendor", "vendor_key", "vendor_key"),
        "fct_trips": "SELECT * FROM fct",
        "fct_key_mapping": """
SELECT service_type, payment_type, vendor_id,
  CAST(CASE WHEN service_type = 'yellow' THEN 1 ELSE 2 END AS INTEGER) AS service_key,
  CAST(CASE WHEN payment_type = 1 THEN 1 WHEN payment_type = 2 THEN 2 ELSE 3 END AS INTEGER)
    AS payment_type_key,
  CAST(CASE WHEN vendor_id = 1 THEN 1 WHEN vendor_id = 2 THEN 2 ELSE 3 END AS INTEGER) AS vendor_key,
  COUNT(*) AS trips
FROM silver GROUP BY service_type, payment_type, vendor_id""",
        "fct_rows_per_month": """
SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month, COUNT(*) AS trips
FROM fct GROUP BY 1""",
        "month_bounds": """
SELECT source_month, month_start, CAST(month_start + INTERVAL 1 MONTH AS DATE) AS month_end,
  'fct_trips_' || strftime(month_start, '%Y_%m') AS partition_name
FROM (SELECT source_month, CAST(strptime(source_month || '-01', '%Y-%m-%d') AS DATE) AS month_start
      FROM (SELECT DISTINCT source_month FROM silver WHERE source_month IS NOT NULL))""",
        "partition_route": f"""
SELECT CASE WHEN pickup_date >= {lo} AND pickup_date < {hi}
            THEN strftime(pickup_date, '%Y_%m') ELSE 'default' END AS partition_name,
  COUNT(*) AS trips
FROM fct GROUP BY 1""",
        "check_not_null": "SELECT * FROM silver WHERE passengers_count IS NULL",
        "check_unique": """
SELECT trip_key AS value, COUNT(*) AS row_count FROM fct WHERE trip_key IS NOT NULL
GROUP BY trip_key HAVING COUNT(*) > 1""",
        "check_unique_sketch": """
SELECT trip_key AS value, COUNT(*) AS row_count FROM fct WHERE trip_key IS NOT NULL
GROUP BY trip_key HAVING COUNT(*) > 1""",
        "check_accepted_values": """
SELECT vendor_id AS value, COUNT(*) AS row_count FROM silver
WHERE vendor_id IS NOT NULL AND vendor_id NOT IN (1, 2) GROUP BY vendor_id""",
        "check_relationships": """
SELECT f.* FROM fct f WHERE f.pickup_date_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.pickup_date_key)""",
        "quality_report": _suite(),
        "quality_by_month": f"""
SELECT s.*, '1998-06-01' AS months_read FROM ({_suite()}) s WHERE s.model = 'fct_trips'""",
        "upper_median": "SELECT " + ", ".join(f"{med(x)} AS {x}" for x in NUMERIC_FACT)
        + " FROM fct",
        "csv_sample_fill": "SELECT trip_key, " + ", ".join(
            f"COALESCE({x}, (SELECT {med(x)} FROM fct)) AS {x}" for x in NUMERIC_FACT)
        + " FROM fct",
        "median_fill": "SELECT trip_key, " + ", ".join(
            f"COALESCE({x}, (SELECT {med(x)} FROM fct)) AS {x}" for x in NUMERIC_FACT)
        + " FROM fct",
    }
