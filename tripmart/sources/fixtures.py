"""Adapter: the supplied TPC-H-shaped tables -> landing-shaped trip and zone data.

The supplied tables hold no trips, so trips are derived one per ``lineitem``
row and zones from ``supplier``, ``nation`` and ``region``, following
FIXTURES.md part 2. The output has the shape of the landing files (TLC column
names and case, integer codes partly as double) plus ``source_month``, the
month file a row belongs to. Everything downstream (bronze, silver, gold,
questions) runs on it unchanged, and the work grows with ``lineitem``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import month_text


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes_seconds(minutes: Column, seconds: Column | None = None) -> Column:
    secs = F.lit(0) if seconds is None else seconds
    return F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"),
                              secs.cast("decimal(18,6)"))


def service_of_line(line_number: Column) -> Column:
    return F.when(line_number % 3 == 0, F.lit("green")).otherwise(F.lit("yellow"))


def landing_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Landing rows of one service: TLC column names plus ``source_month``."""
    li = read_table(spark, sf_dir, "lineitem")
    n_zones_src = read_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    base = ship + _minutes_seconds((ok * 7 + ln * 131) % 1440)
    dropoff = base + _minutes_seconds(F.col("l_quantity").cast("int") - 2, pk % 60)
    price = F.col("l_extendedprice")
    prefix = "tpep" if service == "yellow" else "lpep"
    return (
        li.where(service_of_line(ln) == F.lit(service))
        .select(
            F.when(ln % 4 == 3, F.lit(None)).otherwise(ln % 4).alias("VendorID"),
            F.when(pk % 97 == 0, F.lit(None)).otherwise(base).alias(f"{prefix}_pickup_datetime"),
            dropoff.alias(f"{prefix}_dropoff_datetime"),
            F.when(ok % 17 == 0, F.lit(None))
            .otherwise((ok % 6).cast("double")).alias("passenger_count"),
            ((pk % 100) / 4.0 - 1.0).alias("trip_distance"),
            F.col("l_suppkey").alias("PULocationID"),
            (pk % n_zones_src).alias("DOLocationID"),
            (ok % 6 + 1).cast("double").alias("RatecodeID"),
            F.when(pk % 7 == 0, F.lit(None)).otherwise(pk % 7).alias("payment_type"),
            F.when(pk % 50 == 0, F.lit(0.0)).otherwise(price).alias("fare_amount"),
            (F.col("l_discount") * 100).alias("tip_amount"),
            (F.col("l_tax") * 100).alias("tolls_amount"),
            # left to right, as SQL associates it: (price + tip) + tolls
            (F.when((F.col("l_returnflag") == "R") & (ln == 1), -price).otherwise(price)
             + F.col("l_discount") * 100 + F.col("l_tax") * 100).alias("total_amount"),
            month_text(ship).alias("source_month"),
        )
    )


def landing_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows with the CSV header names ``LocationID, Borough, Zone``.

    nation and region are joined without a hint: their size is estimated from
    the files and the planner broadcasts them when small."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    return (
        s.where(key % 13 != 5)
        .join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.alias("LocationID"),
            F.when(key % 29 == 7, F.lit(None)).otherwise(F.col("r_name")).alias("Borough"),
            F.col("s_name").alias("Zone"),
        )
    )


@dataclass
class Landing:
    yellow: DataFrame
    green: DataFrame
    zones: DataFrame


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(landing_trips(spark, sf_dir, "yellow"),
                   landing_trips(spark, sf_dir, "green"),
                   landing_zones(spark, sf_dir))
