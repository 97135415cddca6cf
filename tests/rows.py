"""Rows of small trip and zone tables for the tests."""

import datetime as dt

TS = dt.datetime


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


YELLOW_DDL = (
    "vendorid bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, pulocationid bigint, dolocationid bigint, "
    "ratecodeid bigint, payment_type bigint, fare_amount double, tip_amount double, "
    "tolls_amount double, total_amount double, source_month string, service_type string"
)
GREEN_DDL = YELLOW_DDL.replace("tpep_", "lpep_")
ZONES_DDL = "locationid bigint, borough string, _zone string"


def trip(pickup="2024-01-01 08:00:00", dropoff="2024-01-01 08:30:00", pu=1, do=2, vendor=1,
         passengers=1, distance=3.0, payment=1, fare=10.0, tip=2.0, tolls=0.0, total=12.0,
         month="2024-01", service="yellow"):
    return (vendor, ts(pickup) if pickup else None, ts(dropoff) if dropoff else None,
            passengers, distance, pu, do, 1, payment, fare, tip, tolls, total, month, service)


def bronze(spark, rows, service="yellow"):
    ddl = YELLOW_DDL if service == "yellow" else GREEN_DDL
    return spark.createDataFrame([r[:-1] + (service,) for r in rows], ddl)


def zones(spark, rows):
    return spark.createDataFrame(rows, ZONES_DDL)
