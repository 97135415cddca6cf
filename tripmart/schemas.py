"""Declared schemas of the silver view and the star schema.

The star tables have fixed DDL (the reference declares them before loading);
``read_star`` reads with these schemas instead of inferring them, and the
tests check that the built DataFrames match them exactly. The DDL is kept as
text and parsed on use (parsing needs a running session).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "decimal(10,2)"

SILVER_DDL = (
    "service_type string, source_month string, vendor_id int, pickup_ts timestamp_ntz, "
    f"dropoff_ts timestamp_ntz, passengers_count int, trip_distance {MONEY}, "
    "pickup_location_id int, dropoff_location_id int, rate_code_id int, payment_type int, "
    f"fare_amount {MONEY}, tip_amount {MONEY}, tolls_amount {MONEY}, total_amount {MONEY}, "
    "pickup_location_name string, dropoff_location_name string")

STAR_DDL = {
    "fct_trips": (
        "trip_key string, pickup_date_key int, pickup_date date, pu_zone_key int, "
        "do_zone_key int, service_key int, payment_type_key int, vendor_key int, "
        "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, passengers_count int, "
        f"trip_distance {MONEY}, fare_amount {MONEY}, tip_amount {MONEY}, "
        f"tolls_amount {MONEY}, total_amount {MONEY}, pickup_month date"),
    "dim_date": ("date_key int, date date, year int, month int, day int, day_of_week int, "
                 "month_start date"),
    "dim_zone": "zone_key int, location_id int, zone_name string, borough string",
    "dim_service_type": "service_id int, service_type string",
    "dim_payment_type": "payment_type_key int, payment_type string",
    "dim_vendor": "vendor_key int, vendor_name string",
}


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def star_schema(name: str) -> StructType:
    return schema(STAR_DDL[name])


def names_and_types(st: StructType) -> list[tuple[str, str]]:
    """Column names and types, ignoring nullability."""
    return [(f.name, f.dataType.simpleString()) for f in st.fields]
