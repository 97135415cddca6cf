"""A rollup of the fact by day, service and pickup zone, kept with the star.

Eleven of the questions only need counts, sums and means by keys of these three.
The rollup holds them as parts that add up exactly: counts, decimal sums, and for a
mean its sum and the number of rows that have a value. Ratios are summed as decimals
of ``RATIO``, so an answer does not depend on how rows were grouped before.

``refresh_rollup`` rebuilds the months whose fact was written anew (the version of the
star says which run wrote a month) and no others; ``read_rollup`` refuses a rollup
that is older than its fact. The answers have the columns of the questions of the same
name in ``plans.questions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import (
    MONEY_SUM,
    duration_micros,
    nulls_large_asc,
    nulls_large_desc,
    round6,
    safe_ratio,
)
from tripmart.operators.gold import Star
from tripmart.operators.joins import join_date, literal
from tripmart.schemas import star_schema
from tripmart.sources import versioned as V

c = F.col
ROLLUP, FACT = "trip_rollup", "fct_trips"
KEYS = ("pickup_date_key", "service_key", "pu_zone_key", "pickup_month")
RATIO = "decimal(38,16)"
PARTS = ("trips", "revenue", "tip_ratio", "tip_n", "micros", "timed_n", "distance", "distance_n")


def build_rollup(fct: DataFrame) -> DataFrame:
    """One combinable aggregate: at most a row for each day, service and zone of a month."""
    ratio = safe_ratio("tip_amount", "fare_amount")
    micros = duration_micros("pickup_ts", "dropoff_ts")
    return fct.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast(MONEY_SUM).alias("revenue"),
        F.sum(ratio.cast(RATIO)).cast(RATIO).alias("tip_ratio"), F.count(ratio).alias("tip_n"),
        F.sum(micros.cast("decimal(38,0)")).alias("micros"), F.count(micros).alias("timed_n"),
        F.sum("trip_distance").cast(MONEY_SUM).alias("distance"), F.count("trip_distance").alias("distance_n")
    ).select(*KEYS[:-1], *PARTS, KEYS[-1])


def _runs(version: V.Version) -> dict[str, str]:
    return {k: p["run"] for k, p in version.of(FACT).items()}


def _key(fact_key: str) -> str:
    return fact_key.replace(f"{FACT}/", f"{ROLLUP}/", 1)


def refresh_rollup(spark: SparkSession, path: str) -> dict:
    """Bring the rollup of the star at ``path`` up to date; the months that were read."""
    base = V.latest(spark, path)
    runs, built = _runs(base), base.info.get(ROLLUP, {})
    there = base.of(ROLLUP)
    changed = sorted(k for k in runs if built.get(k) != runs[k] or _key(k) not in there)
    gone = [_key(k) for k in built if k not in runs]
    if not changed and not gone:
        return {"rows": 0, "months": []}
    rollup = build_rollup(V.read(spark, path, FACT, base, keys=changed, schema=star_schema(FACT)))
    put = V.write(rollup, path, ROLLUP, partition_by=("pickup_month",))
    V.commit(spark, path, base, put, drop=[*gone, *map(_key, changed)],
             info={ROLLUP: runs} | V.schema_info(**{ROLLUP: rollup.schema}))
    return {"rows": sum(p["rows"] for p in put.values()), "months": [k.split("=", 1)[1] for k in changed]}


def read_rollup(spark: SparkSession, path: str, version: V.Version | None = None) -> DataFrame:
    version = version or V.latest(spark, path)
    if version.info.get(ROLLUP) != _runs(version) or {_key(k) for k in version.of(FACT)} != set(version.of(ROLLUP)):
        raise ValueError(f"the rollup at {path} is older than its fact: refresh_rollup brings it up to date")
    return V.read(spark, path, ROLLUP, version)


# Answers ---------------------------------------------------------------------

def _mean(total: str, n: str, scale: float = 1.0):
    """Of summed parts: NULL where no row has a value."""
    return F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0)) / scale


MEASURES = {
    "total_trips": lambda: F.sum("trips"),
    "total_revenue": lambda: F.sum("revenue").cast(MONEY_SUM),
    "avg_tip_percentage": lambda: round6(_mean("tip_ratio", "tip_n") * 100.0),
    "avg_duration_min": lambda: round6(_mean("micros", "timed_n", 60_000_000.0)),
    "avg_distance": lambda: round6(_mean("distance", "distance_n")),
}


def by(star: Star, rollup: DataFrame, groups: Sequence[str], measures: Sequence[str], year: int | None = None) -> DataFrame:
    """Measures of the dated trips by any of year, month, day_of_week, service_type,
    zone_name and borough."""
    d = star.dim_date if year is None else star.dim_date.where(c("year") == year)
    rows = join_date(rollup, d.select("date_key", "month_start", "year", "month", "day_of_week"))
    if "service_type" in groups:
        s = literal(star.dim_service_type)
        rows = rows.join(s, c("service_key") == s.service_id)
    zone = [g for g in groups if g in ("zone_name", "borough")]
    if zone:
        rows = rows.join(star.zones().select(c("zone_key").alias("pu_zone_key"), *zone), "pu_zone_key")
    return rows.groupBy(*groups).agg(*[MEASURES[m]().alias(m) for m in measures])


def _of_zones(star: Star, rollup: DataFrame, *aggs) -> DataFrame:
    """All trips by zone name, also those dated outside the calendar."""
    zones = star.zones().select(c("zone_key").alias("pu_zone_key"), "zone_name")
    return rollup.join(zones, "pu_zone_key").groupBy("zone_name").agg(*aggs)


def _top_revenue(star: Star, rollup: DataFrame) -> DataFrame:
    return (_of_zones(star, rollup, MEASURES["total_revenue"]().alias("total_revenue"))
            .orderBy(nulls_large_desc("total_revenue"), nulls_large_asc("zone_name")).limit(star.settings.top_n))


def _top_tip(star: Star, rollup: DataFrame) -> DataFrame:
    exact = (_mean("tip_ratio", "tip_n") * 100.0).alias("avg_tip_pct")
    top = (_of_zones(star, rollup, MEASURES["total_trips"]().alias("total_trips"), exact)
           .where(c("total_trips") >= star.settings.min_trips)
           .orderBy(nulls_large_desc("avg_tip_pct"), nulls_large_asc("zone_name")).limit(star.settings.top_n))
    return top.withColumn("avg_tip_pct", round6("avg_tip_pct"))


#: Question -> (star, rollup) -> its rows.
ANSWERS = {
    "q01_trips_by_month": lambda s, r: by(s, r, ["month"], ["total_trips"], s.settings.focus_year),
    "q02_trips_by_service_month": lambda s, r: by(s, r, ["year", "month", "service_type"], ["total_trips"]),
    "q07_trips_by_weekday": lambda s, r: by(s, r, ["day_of_week"], ["total_trips"]),
    "q08_revenue_by_month": lambda s, r: by(s, r, ["year", "month"], ["total_revenue"]),
    "q09_revenue_by_service_month": lambda s, r: by(s, r, ["year", "month", "service_type"], ["total_revenue"]),
    "q10_tip_pct_by_month": lambda s, r: by(s, r, ["year", "month"], ["avg_tip_percentage"]),
    "q11_tip_pct_by_borough_month": lambda s, r: by(s, r, ["year", "month", "borough"], ["avg_tip_percentage"]),
    "q12_top_zones_by_revenue": _top_revenue,
    "q13_top_zones_by_tip_pct": _top_tip,
    "q15_avg_duration_by_month": lambda s, r: by(s, r, ["year", "month"], ["avg_duration_min"]),
    "q16_avg_distance_by_month": lambda s, r: by(s, r, ["year", "month"], ["avg_distance"]),
}
