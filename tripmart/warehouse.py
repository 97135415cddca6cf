"""End-to-end refresh: the reference's ingest -> silver -> gold -> checks chain
as plain function calls (no orchestrator).

    plan -> month files present -> bronze tables (months that are new or changed)
         -> silver (lazy) -> star under ``root/gold`` (months that they touch) -> check report

Every step is a Spark job over the whole data; the driver only receives the
file plan, write counts and the one-row-per-check report.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import SERVICES, Settings
from tripmart.operators import bronze as B
from tripmart.operators import checks as K
from tripmart.operators import gold as G
from tripmart.operators import silver as S
from tripmart.sources import landing as L
from tripmart.sources import tables as T
from tripmart.sources import versioned as V


@dataclass
class Refresh:
    star: G.Star
    silver: DataFrame
    coverage: DataFrame
    loads: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)


def bronze_paths(root: str, services=SERVICES) -> dict[str, str]:
    return {svc: f"{root}/bronze/{svc}_tripdata" for svc in services}


def bronze_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    yellow, green = (V.read(spark, path, B.TRIPS) for path in bronze_paths(root).values())
    return yellow, green, spark.read.parquet(f"{root}/bronze/taxi_zone_lookup")


def refresh(spark: SparkSession, landing_dir: str, zones_landing: DataFrame, root: str,
            settings: Settings, rebalance_fact: bool = False,
            run_checks: bool = True) -> Refresh:
    """Load the planned months that are new in ``landing_dir`` and bring the star up
    to date with them.

    ``zones_landing`` is the zone lookup as read (``landing.read_zone_lookup``
    for the CSV); it fully replaces the bronze lookup, unless it is empty: then
    the old lookup stays. Months whose files are as they were when loaded are not
    read, months already in bronze and absent from the landing folder stay as they
    are. Of the fact only the months are rewritten that hold trips of a changed
    month, before or after; another lookup or other settings rewrite all of it. A
    refresh that fails between the two commits is completed by the next one."""
    plan = L.load_plan(spark, settings.plan_start, settings.plan_end, settings.services)
    lookup = f"{root}/bronze/taxi_zone_lookup"
    loads = {"zones": T.replace_table(B.to_bronze_zones(zones_landing), lookup, observe="zones")}
    if loads["zones"].get("skipped") and not T.table_exists(spark, lookup):
        raise ValueError("the zone lookup is empty and there is no earlier one")
    files = L.planned_fingerprints(spark, plan, landing_dir)
    paths = bronze_paths(root)
    for svc in settings.services:
        loads[svc] = B.load_changed(spark, files, paths[svc], svc)
    versions = {svc: V.latest(spark, path) for svc, path in paths.items()}
    zones = spark.read.parquet(lookup)
    size, checksum = zones.agg(F.count(F.lit(1)), B.row_checksum(zones)).first()

    def bronze(svc: str, keys: list[str] | None) -> DataFrame:
        return V.read(spark, paths[svc], B.TRIPS, versions[svc], keys=keys)

    def silver(keys: list[str] | None = None) -> DataFrame:
        return S.silver_trips(*(bronze(svc, keys) for svc in SERVICES), zones, settings.broadcast_max_rows, size)

    sources = {k: p for v in versions.values() for k, p in v.of(B.TRIPS).items()}
    loads["fct_trips"] = G.refresh_star(
        spark, lambda keys: G.build_star(spark, silver(keys), zones, settings, size), f"{root}/gold", sources,
        {"lookup": f"{size}:{checksum}", "settings": repr(settings)}, rebalance_fact)
    for path in paths.values():
        V.vacuum(spark, path)
    star = G.read_star(spark, f"{root}/gold", settings)
    loaded = B.ledger(spark, paths.values())
    out = Refresh(star, silver(), B.coverage(plan, loaded), loads)
    if run_checks:
        models = {"silver_trips": out.silver, "zone_lookup": zones,
                  "dim_service_type": star.dim_service_type,
                  "dim_payment_type": star.dim_payment_type, "dim_zone": star.dim_zone,
                  "dim_date": star.dim_date, "fct_trips": star.fct}
        out.checks = [r.asDict() for r in
                      K.run_checks(spark, K.REFERENCE_SUITE, models).collect()]
    return out
