"""Silver: both services cast to one shape, unioned, joined to zone names
twice and filtered for quality. A lazy DataFrame (the reference's view):
Catalyst pushes the quality predicates below the joins and prunes columns
the caller does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.columns import MONEY
from tripmart.operators.joins import bounded

TRIP_COLUMNS = (
    "service_type", "source_month", "vendor_id", "pickup_ts", "dropoff_ts",
    "passengers_count", "trip_distance", "pickup_location_id", "dropoff_location_id",
    "rate_code_id", "payment_type", "fare_amount", "tip_amount", "tolls_amount",
    "total_amount",
)
SILVER_COLUMNS = TRIP_COLUMNS + ("pickup_location_name", "dropoff_location_name")


def project_service(bronze: DataFrame, ts_prefix: str) -> DataFrame:
    """Rename and cast one service's bronze columns to the 15 trip columns.
    ``ts_prefix`` is ``tpep`` (yellow) or ``lpep`` (green)."""
    c = F.col
    return bronze.select(
        c("service_type"),
        c("source_month"),
        c("vendorid").cast("int").alias("vendor_id"),
        c(f"{ts_prefix}_pickup_datetime").cast("timestamp_ntz").alias("pickup_ts"),
        c(f"{ts_prefix}_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        c("passenger_count").cast("int").alias("passengers_count"),
        c("trip_distance").cast(MONEY).alias("trip_distance"),
        c("pulocationid").cast("int").alias("pickup_location_id"),
        c("dolocationid").cast("int").alias("dropoff_location_id"),
        c("ratecodeid").cast("int").alias("rate_code_id"),
        c("payment_type").cast("int").alias("payment_type"),
        c("fare_amount").cast(MONEY).alias("fare_amount"),
        c("tip_amount").cast(MONEY).alias("tip_amount"),
        c("tolls_amount").cast(MONEY).alias("tolls_amount"),
        c("total_amount").cast(MONEY).alias("total_amount"),
    )


def union_services(yellow: DataFrame, green: DataFrame) -> DataFrame:
    return project_service(yellow, "tpep").unionByName(project_service(green, "lpep"))


def zone_names(zones_bronze: DataFrame) -> DataFrame:
    return zones_bronze.select(F.col("locationid").cast("int").alias("location_id"),
                               F.col("_zone").alias("zone_name"))


def quality_predicate():
    """Both timestamps present, pickup not after drop-off, distance and total
    not negative. NULL in a number fails the row (three-valued logic)."""
    c = F.col
    return (c("pickup_ts").isNotNull() & c("dropoff_ts").isNotNull()
            & (c("pickup_ts") <= c("dropoff_ts"))
            & (c("trip_distance") >= 0) & (c("total_amount") >= 0))


def silver_trips(yellow: DataFrame, green: DataFrame, zones_bronze: DataFrame,
                 max_broadcast_rows: int = 1_000_000, zone_rows: int | None = None) -> DataFrame:
    """The unified trip view: 15 trip columns + pickup/drop-off zone names.

    Trips with an unknown zone drop out (inner joins). The zone table is
    broadcast only after its row count (``zone_rows`` when already known) is
    checked against the bound."""
    trips = union_services(yellow, green).where(quality_predicate())
    zones = bounded(zone_names(zones_bronze), max_broadcast_rows, zone_rows)
    zp = zones.select(F.col("location_id").alias("_pu_id"),
                      F.col("zone_name").alias("pickup_location_name"))
    zd = zones.select(F.col("location_id").alias("_do_id"),
                      F.col("zone_name").alias("dropoff_location_name"))
    return (trips
            .join(zp, trips.pickup_location_id == zp._pu_id)
            .join(zd, trips.dropoff_location_id == zd._do_id)
            .select(*SILVER_COLUMNS))


REJECT_REASONS = (
    "null_pickup_ts", "null_dropoff_ts", "pickup_after_dropoff",
    "negative_or_null_distance", "negative_or_null_total",
    "unknown_pickup_zone", "unknown_dropoff_zone", "rejected", "kept",
)


def silver_rejects(yellow: DataFrame, green: DataFrame, zones_bronze: DataFrame,
                   max_broadcast_rows: int = 1_000_000, zone_rows: int | None = None) -> DataFrame:
    """Rows per reject reason (reasons overlap), plus ``rejected`` and ``kept``.

    One scan: each row gets its flags, one aggregate sums them, and the one
    result row is unpivoted. Zone existence uses the distinct key set, so a
    duplicated zone id cannot multiply trips."""
    c = F.col
    trips = union_services(yellow, green)
    keys = zone_names(zones_bronze).select("location_id").distinct()
    keys = bounded(keys, max_broadcast_rows, zone_rows)
    pu = keys.select(c("location_id").alias("_pu_id"), F.lit(True).alias("_pu_ok"))
    do = keys.select(c("location_id").alias("_do_id"), F.lit(True).alias("_do_ok"))
    flagged = (trips.join(pu, trips.pickup_location_id == pu._pu_id, "left")
               .join(do, trips.dropoff_location_id == do._do_id, "left"))
    flags = {
        "null_pickup_ts": c("pickup_ts").isNull(),
        "null_dropoff_ts": c("dropoff_ts").isNull(),
        "pickup_after_dropoff": c("pickup_ts") > c("dropoff_ts"),
        "negative_or_null_distance": F.coalesce(c("trip_distance") < 0, F.lit(True)),
        "negative_or_null_total": F.coalesce(c("total_amount") < 0, F.lit(True)),
        "unknown_pickup_zone": c("_pu_ok").isNull(),
        "unknown_dropoff_zone": c("_do_ok").isNull(),
    }
    kept = quality_predicate() & c("_pu_ok").isNotNull() & c("_do_ok").isNotNull()
    aggs = [F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in flags.items()]
    aggs += [F.count_if(~F.coalesce(kept, F.lit(False))).alias("rejected"),
             F.count_if(F.coalesce(kept, F.lit(False))).alias("kept")]
    one = flagged.agg(*aggs)
    return one.unpivot([], list(REJECT_REASONS), "reason", "row_count")
