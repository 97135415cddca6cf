"""Available-now stream ingest: exactly-once across reruns, new months picked up."""

import pandas as pd
from pyspark.sql import functions as F

from tripmart.streaming import start_ingest


def land_month(folder, month, n):
    start = pd.Timestamp(f"{month}-03 09:00:00")
    df = pd.DataFrame({
        "VendorID": pd.array([2] * n, dtype="int32"),
        "tpep_pickup_datetime": [start] * n,
        "tpep_dropoff_datetime": [start + pd.Timedelta(minutes=7)] * n,
        "passenger_count": [1.0] * n, "trip_distance": [1.5] * n,
        "PULocationID": [4] * n, "DOLocationID": [5] * n, "RatecodeID": [1.0] * n,
        "payment_type": [2] * n, "fare_amount": [8.0] * n, "tip_amount": [0.0] * n,
        "tolls_amount": [0.0] * n, "total_amount": [8.0] * n,
    })
    d = folder / f"source_month={month}"
    d.mkdir(parents=True)
    df.to_parquet(d / "part-0.parquet", index=False, coerce_timestamps="us")


def counts(spark, path):
    return {(r.source_month, r.n) for r in spark.read.parquet(path)
            .groupBy("source_month").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_stream_ingest_exactly_once(spark, tmp_path):
    land, bronze, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    land_month(land, "2024-01", 3)
    start_ingest(spark, str(land), "yellow", bronze, ckpt).awaitTermination()
    assert counts(spark, bronze) == {("2024-01", 3)}
    # a rerun with the same checkpoint adds nothing
    start_ingest(spark, str(land), "yellow", bronze, ckpt).awaitTermination()
    assert counts(spark, bronze) == {("2024-01", 3)}
    # a newly landed month is picked up, the old one is not read again
    land_month(land, "2024-02", 2)
    start_ingest(spark, str(land), "yellow", bronze, ckpt).awaitTermination()
    assert counts(spark, bronze) == {("2024-01", 3), ("2024-02", 2)}
    row = spark.read.parquet(bronze).first()
    assert row.service_type == "yellow" and row.vendorid == 2 and row.passenger_count == 1


def test_stream_and_batch_take_turns(spark, tmp_path):
    """A month replaced by the batch loader is there for the next stream run,
    and a second file of a month brings the whole month."""
    from tripmart.operators.bronze import load_months, to_bronze_trips
    from tripmart.streaming.ingest import landing_schema

    land, bronze, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    land_month(land, "2024-01", 3)
    land_month(land, "2024-02", 4)
    start_ingest(spark, str(land), "yellow", bronze, ckpt).awaitTermination()
    month = spark.read.schema(landing_schema("yellow")).parquet(str(land)).where("source_month = '2024-01'")
    load_months(spark, to_bronze_trips(month.limit(1), "yellow"), bronze)
    assert counts(spark, bronze) == {("2024-01", 1), ("2024-02", 4)}
    (land / "source_month=2024-02" / "part-1.parquet").write_bytes(
        (land / "source_month=2024-02" / "part-0.parquet").read_bytes())
    start_ingest(spark, str(land), "yellow", bronze, ckpt).awaitTermination()
    assert counts(spark, bronze) == {("2024-01", 1), ("2024-02", 8)}
