"""Gold: a star schema with one trip fact and five dimensions.

The fact carries one extra column, ``pickup_month`` (first day of the pickup
month). It is the range-partition column of the written fact (one directory
per month, which replaces the reference's 48 declared partitions plus a
default one) and the second key of the calendar join, so a year filter on the
calendar prunes month directories.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import PAYMENT_TYPES, SERVICE_KEYS, VENDORS, Settings
from tripmart.functions.columns import (
    date_key,
    iso_day_of_week,
    month_start,
    partition_suffix,
    trip_key,
)
from tripmart.operators.joins import bounded
from tripmart.sources import versioned as V

FACT_COLUMNS = (
    "trip_key", "pickup_date_key", "pickup_date", "pu_zone_key", "do_zone_key",
    "service_key", "payment_type_key", "vendor_key", "pickup_ts", "dropoff_ts",
    "passengers_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount",
    "total_amount",
)
DATE_COLUMNS = ("date_key", "date", "year", "month", "day", "day_of_week")


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    """One row per day of the settings' calendar, plus ``month_start``.

    Its size is the number of days in the settings, so it is safe to broadcast."""
    days = F.sequence(F.lit(settings.calendar_start), F.lit(settings.calendar_end),
                      F.expr("interval 1 day"))
    d = F.col("date")
    return (spark.range(1).select(F.explode(days).alias("date"))
            .select(date_key(d).alias("date_key"), d,
                    F.year(d).cast("int").alias("year"),
                    F.month(d).cast("int").alias("month"),
                    F.dayofmonth(d).cast("int").alias("day"),
                    iso_day_of_week(d).alias("day_of_week"),
                    month_start(d).alias("month_start")))


def _literal_dim(spark: SparkSession, rows: dict, key: str, name: str) -> DataFrame:
    """A small fixed relation built on the JVM side (no Python worker)."""
    structs = [F.struct(F.lit(k).cast("int").alias(key), F.lit(v).cast("string").alias(name))
               for k, v in sorted(rows.items())]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_service_type(spark: SparkSession) -> DataFrame:
    inv = {v: k for k, v in SERVICE_KEYS.items()}
    return _literal_dim(spark, inv, "service_id", "service_type")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _literal_dim(spark, PAYMENT_TYPES, "payment_type_key", "payment_type")


def dim_vendor(spark: SparkSession) -> DataFrame:
    return _literal_dim(spark, VENDORS, "vendor_key", "vendor_name")


def dim_zone(zones_bronze: DataFrame) -> DataFrame:
    return zones_bronze.select(F.col("locationid").cast("int").alias("zone_key"),
                               F.col("locationid").cast("int").alias("location_id"),
                               F.col("_zone").alias("zone_name"),
                               F.col("borough"))


def key_mapping():
    """Code -> dimension key. NULL and unknown codes fall to the last key."""
    c = F.col
    service = F.when(c("service_type") == "yellow", 1).otherwise(2)
    payment = (F.when(c("payment_type") == 1, 1).when(c("payment_type") == 2, 2)
               .otherwise(3))
    vendor = F.when(c("vendor_id") == 1, 1).when(c("vendor_id") == 2, 2).otherwise(3)
    return service, payment, vendor


def fct_trips(silver: DataFrame) -> DataFrame:
    """One row per silver trip: surrogate key, date key, dimension keys,
    measures, and ``pickup_month`` for partitioning."""
    c = F.col
    service, payment, vendor = key_mapping()
    pickup_date = c("pickup_ts").cast("date")
    return silver.select(
        trip_key("service_type", "pickup_ts", "dropoff_ts", "pickup_location_id",
                 "dropoff_location_id").alias("trip_key"),
        date_key("pickup_ts").alias("pickup_date_key"),
        pickup_date.alias("pickup_date"),
        c("pickup_location_id").alias("pu_zone_key"),
        c("dropoff_location_id").alias("do_zone_key"),
        service.cast("int").alias("service_key"),
        payment.cast("int").alias("payment_type_key"),
        vendor.cast("int").alias("vendor_key"),
        "pickup_ts", "dropoff_ts", "passengers_count", "trip_distance",
        "fare_amount", "tip_amount", "tolls_amount", "total_amount",
        month_start(pickup_date).alias("pickup_month"),
    )


def declared_range(settings: Settings):
    """[first month, month after the last) of the declared month partitions."""
    lo = F.trunc(F.lit(settings.calendar_start), "MM")
    hi = F.add_months(F.trunc(F.lit(settings.calendar_end), "MM"), 1)
    return lo, hi


def partition_route(pickup_date, settings: Settings):
    """``yyyy_MM`` of the month partition a row belongs to, or ``default``
    when the date is outside the declared months (or NULL)."""
    d = F.col(pickup_date) if isinstance(pickup_date, str) else pickup_date
    lo, hi = declared_range(settings)
    return F.when((d >= lo) & (d < hi), partition_suffix(d)).otherwise(F.lit("default"))


def month_bounds(silver: DataFrame) -> DataFrame:
    """Months present in silver: ``source_month, month_start, month_end,
    partition_name`` (the reference's data-driven partition list)."""
    start = F.to_date(F.concat(F.col("source_month"), F.lit("-01")), "yyyy-MM-dd")
    return (silver.where(F.col("source_month").isNotNull())
            .select("source_month").distinct()
            .select("source_month", start.alias("month_start"),
                    F.add_months(start, 1).alias("month_end"),
                    F.concat(F.lit("fct_trips_"), partition_suffix(start)).alias("partition_name")))


@dataclass
class Star:
    fct: DataFrame
    dim_date: DataFrame
    dim_zone: DataFrame
    dim_service_type: DataFrame
    dim_payment_type: DataFrame
    dim_vendor: DataFrame
    settings: Settings
    zone_rows: int | None = None
    zone_bounded: DataFrame | None = None

    def zones(self) -> DataFrame:
        """dim_zone, broadcast if its counted size is within the bound."""
        if self.zone_bounded is None:
            self.zone_bounded = bounded(self.dim_zone, self.settings.broadcast_max_rows,
                                        self.zone_rows)
        return self.zone_bounded


def build_star(spark: SparkSession, silver: DataFrame, zones_bronze: DataFrame,
               settings: Settings, zone_rows: int | None = None) -> Star:
    """The lazy star (nothing is written). ``zone_rows``: the lookup's row
    count if already known, for the broadcast check of ``dim_zone``."""
    return Star(fct_trips(silver), dim_date(spark, settings), dim_zone(zones_bronze),
                dim_service_type(spark), dim_payment_type(spark), dim_vendor(spark),
                settings, zone_rows)


DIMENSIONS = ("dim_date", "dim_zone", "dim_service_type", "dim_payment_type", "dim_vendor")


def write_dimensions(star: Star, path: str) -> dict[str, dict]:
    """The dimensions as new, uncommitted parts (full replaces)."""
    return (V.write(star.dim_date, path, "dim_date") | V.write(star.dim_zone, path, "dim_zone")
            | V.write(star.dim_service_type, path, "dim_service_type", accepted={"service_type": SERVICE_KEYS.keys()})
            | V.write(star.dim_payment_type, path, "dim_payment_type", accepted={"payment_type": PAYMENT_TYPES.values()})
            | V.write(star.dim_vendor, path, "dim_vendor"))


def write_fact(fct: DataFrame, path: str, rebalance: bool = False) -> dict[str, dict]:
    """The fact as new, uncommitted parts, one for each pickup month."""
    return V.write(fct, path, "fct_trips", partition_by=("pickup_month",),
                   rebalance=("pickup_month",) if rebalance else None, observe="fct_trips")


def write_star(spark: SparkSession, star: Star, path: str, rebalance: bool = False,
               keep_old: bool = False, info: dict | None = None) -> Star:
    """Materialize the star under ``path`` and return it read back.

    The fact is partitioned by ``pickup_month``. By default the write is
    map-only: bronze is partitioned by ``source_month``, so every input split
    holds (almost) one month and writes one file, with no shuffle of the fact.
    ``rebalance=True`` adds a REBALANCE on the month for inputs that are not
    clustered by month: AQE then splits a hot month over several tasks and
    packs small months together, at the price of one shuffle of the fact.
    Dimensions are full replaces (the reference truncates and appends). All
    tables are committed as one version (``sources.versioned``): readers of the
    old one keep its files, which go ``V.KEEP_HOURS`` after they were replaced
    (``keep_old``: not at all), and of two writers the later one raises
    ``V.Conflict``."""
    base = V.latest(spark, path)
    put: dict[str, dict] = {}
    try:
        put |= write_fact(star.fct, path, rebalance)
        put |= write_dimensions(star, path)
    except Exception:
        V.discard(spark, path, put)
        raise
    from tripmart.schemas import STAR_DDL, star_schema

    V.commit(spark, path, base, put, info=V.schema_info(**{t: star_schema(t) for t in STAR_DDL}) | (info or {}), whole=True)
    if not keep_old:
        V.vacuum(spark, path)
    return read_star(spark, path, star.settings)


def refresh_star(spark: SparkSession, star: Callable[[list[str] | None], Star], path: str, sources: dict[str, dict],
                 context: dict, rebalance: bool = False) -> dict:
    """Bring the written star up to date with its sources, and say what was written:
    ``rows`` and ``months`` of the fact.

    ``sources``: for each source part its ``run`` and the ``pickup_months`` of its trips
    (kept with the version that was built from them). A part whose run differs from
    the one that the written star was built from has changed: the fact's months that
    its trips fall into, then or now, are rebuilt from every source part that has
    trips in them, so that a trip dated outside its month's file is neither lost nor
    doubled. ``star(keys)`` gives the star of those parts (all of them for None). Other
    months keep their files. A change of ``context`` (lookup, settings) or a missing star
    rebuilds everything. One commit replaces the months and the dimensions."""
    base = V.latest(spark, path)
    before = base.info.get("sources", {})
    now = {k: {"run": p["run"], "pickup_months": p["pickup_months"]} for k, p in sources.items()}
    info = {"sources": now, "context": context}
    if not base.number or base.info.get("context") != context:
        write_star(spark, star(None), path, rebalance, info=info)
        months = sorted(k.split("=", 1)[1] for k in V.latest(spark, path).of("fct_trips"))
        return {"rows": V.latest(spark, path).rows("fct_trips"), "months": months, "full": True}
    changed = [k for k in before.keys() | now.keys() if before.get(k) != now.get(k)]
    months = sorted({m for k in changed for side in (before, now) for m in side.get(k, {}).get("pickup_months", [])})
    if not changed:
        return {"rows": 0, "months": [], "full": False}
    feeding = [k for k, p in now.items() if set(p["pickup_months"]) & set(months)]
    part = star(feeding)
    put = write_fact(part.fct.where(F.col("pickup_month").isin([dt.date.fromisoformat(m) for m in months])),
                     path, rebalance)
    rows = sum(p["rows"] for p in put.values())
    put |= write_dimensions(part, path)
    V.commit(spark, path, base, put, drop=[f"fct_trips/pickup_month={m}" for m in months], info=info)
    V.vacuum(spark, path)
    return {"rows": rows, "months": months, "full": False}


def read_star(spark: SparkSession, path: str, settings: Settings, version: V.Version | None = None) -> Star:
    """The written star as of a version (the latest if none is given), read with
    its declared schemas (no inference; the fact's ``pickup_month`` directories read
    as dates)."""
    from tripmart.schemas import STAR_DDL, star_schema

    version = version or V.latest(spark, path)
    if not version.number:
        raise FileNotFoundError(f"no star at {path}")
    t = {name: V.read(spark, path, name, version, schema=star_schema(name)) for name in STAR_DDL}
    return Star(t["fct_trips"], t["dim_date"], t["dim_zone"], t["dim_service_type"],
                t["dim_payment_type"], t["dim_vendor"], settings)
