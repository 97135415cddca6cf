"""Incremental bronze ingest with Structured Streaming.

The reference runs its month load on a schedule. Here a file-source stream
watches a landing folder laid out as ``<landing>/source_month=YYYY-MM/*.parquet``.
Each micro-batch only says which months have new files; those months are read
whole from the landing folder and loaded by the batch loader
(``operators.bronze.load_months``), which replaces exactly them. So a stream
and a batch load of a corrected month can take turns on one bronze table, and
a batch that runs again after a failure leaves one copy of its months.
``trigger(availableNow=True)`` processes everything landed so far and stops,
which is what a scheduled job wants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmart.operators.bronze import load_months, to_bronze_trips


def landing_schema(service: str) -> StructType:
    """Landing file columns (TLC names) plus the ``source_month`` folder."""
    p = "tpep" if service == "yellow" else "lpep"
    return StructType.fromDDL(
        f"VendorID int, {p}_pickup_datetime timestamp_ntz, {p}_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, PULocationID bigint, "
        "DOLocationID bigint, RatecodeID double, payment_type bigint, fare_amount double, "
        "tip_amount double, tolls_amount double, total_amount double, source_month string")


def start_ingest(spark: SparkSession, landing_dir: str, service: str, bronze_path: str,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Load the months with newly landed files into the bronze table at
    ``bronze_path``, each as a whole."""
    schema = landing_schema(service)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, _: int) -> None:
        # at most one row per month
        months = [r[0] for r in batch.select("source_month").distinct().collect()]
        if months:
            own = batch.sparkSession
            landed = own.read.schema(schema).parquet(landing_dir).where(F.col("source_month").isin(months))
            load_months(own, to_bronze_trips(landed, service), bronze_path)

    # the folder's name alone tells the months: no column of the files is read
    w = (reader.parquet(landing_dir).select("source_month").writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
