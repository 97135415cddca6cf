import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripmart.config import REFERENCE
from tripmart.operators import bronze as B
from tripmart.operators import gold as G
from tripmart.sources import landing as L


def landing_file(folder, service, month, n=3, drop=(), extra=None, passengers=1.0):
    prefix = "tpep" if service == "yellow" else "lpep"
    start = pd.Timestamp(f"{month}-05 10:00:00")
    df = pd.DataFrame({
        "VendorID": [1] * n,
        f"{prefix}_pickup_datetime": [start] * n,
        f"{prefix}_dropoff_datetime": [start + pd.Timedelta(minutes=12)] * n,
        "passenger_count": [passengers] * n,
        "trip_distance": [2.5] * n,
        "RatecodeID": [1.0] * n,
        "PULocationID": [10] * n,
        "DOLocationID": [20] * n,
        "payment_type": [1] * n,
        "fare_amount": [10.0] * n,
        "tip_amount": [2.0] * n,
        "tolls_amount": [0.0] * n,
        "total_amount": [12.0] * n,
    })
    df = df.drop(columns=list(drop))
    for k, v in (extra or {}).items():
        df[k] = v
    path = folder / L.trip_file_name(service, month)
    df.to_parquet(path, index=False, coerce_timestamps="us")
    return path


def counts(spark, path):
    return {(r.source_month, r.n) for r in spark.read.parquet(path)
            .groupBy("source_month").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_plan_starts_at_next_month_start(spark):
    plan = L.load_plan(spark, "2022-01-15", "2022-03-31").collect()
    assert sorted({r.source_month for r in plan}) == ["2022-02", "2022-03"]
    assert len(plan) == 4 and {r.service_type for r in plan} == {"yellow", "green"}


def test_plan_defaults_are_24_months_by_two_services(spark):
    assert L.load_plan(spark).count() == 48


def test_same_month_twice_leaves_one_copy_and_empty_month_changes_nothing(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land, "yellow", "2024-01", n=3)
    landing_file(land, "yellow", "2024-02", n=2)
    plan = L.load_plan(spark, "2024-01-01", "2024-02-28", ["yellow"])
    bronze_dir = str(tmp_path / "bronze")
    B.load_from_landing(spark, str(land), plan, bronze_dir, ["yellow"])
    rep = B.load_from_landing(spark, str(land), plan, bronze_dir, ["yellow"])
    assert rep["yellow"]["rows"] == 5
    table = f"{bronze_dir}/yellow_tripdata"
    assert counts(spark, table) == {("2024-01", 3), ("2024-02", 2)}
    empty = spark.read.parquet(table).where(F.lit(False))
    B.load_months(spark, empty, table)
    assert counts(spark, table) == {("2024-01", 3), ("2024-02", 2)}


def test_missing_month_file_is_skipped_and_reported_missing(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land, "green", "2024-01")
    plan = L.load_plan(spark, "2024-01-01", "2024-02-29", ["green"])
    bronze_dir = str(tmp_path / "bronze")
    B.load_from_landing(spark, str(land), plan, bronze_dir, ["green"])
    loaded = B.loaded_months(spark.read.parquet(f"{bronze_dir}/green_tripdata"))
    cov = {(r.year_month, r.status) for r in B.coverage(plan, loaded).collect()}
    assert cov == {("2024-01", "loaded"), ("2024-02", "missing")}


def test_new_column_dropped_and_missing_column_null(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land, "yellow", "2024-01")
    plan1 = L.load_plan(spark, "2024-01-01", "2024-01-31", ["yellow"])
    bronze_dir = str(tmp_path / "bronze")
    B.load_from_landing(spark, str(land), plan1, bronze_dir, ["yellow"])
    landing_file(land, "yellow", "2024-02", drop=["passenger_count"], extra={"airport_fee": 1.25})
    plan2 = L.load_plan(spark, "2024-02-01", "2024-02-29", ["yellow"])
    rep = B.load_from_landing(spark, str(land), plan2, bronze_dir, ["yellow"])
    assert rep["yellow"]["dropped_columns"] == ["airport_fee"]
    t = spark.read.parquet(f"{bronze_dir}/yellow_tripdata")
    assert "airport_fee" not in t.columns
    feb = t.where("source_month = '2024-02'").select("passenger_count").distinct().collect()
    assert [r[0] for r in feb] == [None]


def test_names_equal_after_lower_case_raise(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`Fee` double, `fee` double")
    with pytest.raises(ValueError, match="differ only by case"):
        L.lower_case_columns(df)


def test_fraction_in_integer_column_raises(spark):
    df = spark.createDataFrame([(1.5,), (2.0,)], "passenger_count double")
    with pytest.raises(Exception, match="fractional value"):
        B.repair_int_columns(df).collect()
    ok = spark.createDataFrame([(1.0,), (None,)], "passenger_count double")
    assert [r[0] for r in B.repair_int_columns(ok).collect()] == [1, None]
    assert dict(B.repair_int_columns(ok).dtypes)["passenger_count"] == "bigint"


def test_fact_month_routing(spark):
    dates = [dt.date(2021, 12, 31), dt.date(2022, 1, 1), dt.date(2025, 12, 31), dt.date(2026, 1, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "pickup_date date")
    got = [r[0] for r in df.select(G.partition_route("pickup_date", REFERENCE)).collect()]
    assert got == ["default", "2022_01", "2025_12", "default"]


def test_zone_ingest_constants_and_reserved_name(spark):
    land = spark.createDataFrame([(1, "Queens", "Astoria")], "LocationID bigint, Borough string, Zone string")
    z = B.to_bronze_zones(land)
    r = z.first()
    assert {"locationid", "borough", "_zone", "ingest_ts"} <= set(z.columns)
    assert (r.source_month, r.service_type, r._zone) == ("static", "lookup", "Astoria")


def test_schema_groups_in_one_load_report_dropped(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land, "yellow", "2024-01")
    landing_file(land, "yellow", "2024-02", extra={"congestion_surcharge": 2.5})
    plan = L.load_plan(spark, "2024-01-01", "2024-02-29", ["yellow"])
    rep = B.load_from_landing(spark, str(land), plan, str(tmp_path / "bronze"), ["yellow"])
    assert rep["yellow"]["rows"] == 6
    assert rep["yellow"]["dropped_columns"] == ["congestion_surcharge"]


def test_cluster_conf_sizes_partitions():
    from tripmart.session import cluster_conf

    conf = cluster_conf(1000 * 8, shuffle_bytes=100 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(16)["spark.sql.shuffle.partitions"] == "48"


def test_unreadable_month_file_is_skipped_and_old_rows_stay(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    landing_file(land, "yellow", "2024-01", n=3)
    landing_file(land, "yellow", "2024-02", n=2)
    plan = L.load_plan(spark, "2024-01-01", "2024-02-29", ["yellow"])
    bronze_dir = str(tmp_path / "bronze")
    B.load_from_landing(spark, str(land), plan, bronze_dir, ["yellow"])
    # February is re-delivered broken, January re-delivered with more rows
    (land / L.trip_file_name("yellow", "2024-02")).write_bytes(b"not a parquet file")
    landing_file(land, "yellow", "2024-01", n=4)
    rep = B.load_from_landing(spark, str(land), plan, bronze_dir, ["yellow"])
    assert rep["yellow"]["failed_months"] == ["2024-02"]
    assert counts(spark, f"{bronze_dir}/yellow_tripdata") == {("2024-01", 4), ("2024-02", 2)}


def test_loaded_months_from_listing_equals_from_rows(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    for m in ("2024-01", "2024-03"):
        landing_file(land, "green", m)
    plan = L.load_plan(spark, "2024-01-01", "2024-03-31", ["green"])
    bronze_dir = str(tmp_path / "bronze")
    B.load_from_landing(spark, str(land), plan, bronze_dir, ["green"])
    table = f"{bronze_dir}/green_tripdata"
    listed = {tuple(r) for r in B.loaded_months_listed(spark, table).collect()}
    rows = {tuple(r) for r in B.loaded_months(spark.read.parquet(table)).collect()}
    assert listed == rows == {("green", "2024-01"), ("green", "2024-03")}
