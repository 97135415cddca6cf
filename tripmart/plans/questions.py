"""The 20 business questions over the star schema.

Each is ``qNN_name(star, **args) -> DataFrame``; literals of the reference
(year, top-n, minimum trips, payment classes) are arguments defaulting to the
star's settings. Ordering rules, fixed once for all questions:

* ties in ``row_number`` and ``limit`` are broken by the group key;
* NULL sorts as the largest value (first in descending, last in ascending);
* counts are ``bigint``, money sums ``decimal(28,2)``, ratios and means
  ``double`` rounded to 6 places.

Questions that join the calendar drop trips dated outside it; those that do
not (12-14, 17-20) count them, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.columns import (
    hours_between,
    minutes_between,
    money_sum,
    nulls_large_asc,
    nulls_large_desc,
    round6,
    safe_ratio,
    tip_pct,
    tip_pct_exact,
)
from tripmart.operators.gold import Star
from tripmart.operators.joins import join_date, literal
from tripmart.operators.percentiles import percentile_cont

c = F.col


def _n():
    return F.count(F.lit(1))


def _dated(star: Star, year: int | None = None) -> DataFrame:
    """Fact joined to the calendar (optionally one year of it)."""
    d = star.dim_date
    if year is not None:
        d = d.where(c("year") == year)
    return join_date(star.fct, d.select("date_key", "month_start", "year", "month",
                                        "day_of_week"))


def _zone(star: Star, key: str, cols=("zone_name", "borough")) -> DataFrame:
    z = star.zones().select(c("zone_key").alias(key), *cols)
    return z


def _top(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _rank_within(df: DataFrame, part, order, n: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(c("_rn") <= n)


# 1. Demand and seasonality ---------------------------------------------------

def q01_trips_by_month(star: Star, year: int | None = None) -> DataFrame:
    year = star.settings.focus_year if year is None else year
    return (_dated(star, year).groupBy("month").agg(_n().alias("total_trips"))
            .orderBy("month"))


def q02_trips_by_service_month(star: Star) -> DataFrame:
    s = literal(star.dim_service_type)
    return (_dated(star).join(s, c("service_key") == s.service_id)
            .groupBy("year", "month", "service_type").agg(_n().alias("total_trips"))
            .orderBy("year", "month", "service_type"))


def _top_zones_in_year(star: Star, key: str, year, n) -> DataFrame:
    year = star.settings.focus_year if year is None else year
    n = star.settings.top_n if n is None else n
    z = _zone(star, key, ("zone_name",))
    agg = (_dated(star, year).join(z, key).groupBy("zone_name")
           .agg(_n().alias("total_trips")))
    return _top(agg, n, nulls_large_desc("total_trips"), nulls_large_asc("zone_name"))


def q03_top_pickup_zones(star: Star, year: int | None = None, n: int | None = None) -> DataFrame:
    return _top_zones_in_year(star, "pu_zone_key", year, n)


def q04_top_dropoff_zones(star: Star, year: int | None = None, n: int | None = None) -> DataFrame:
    """Drop-off zone, but the year is the pickup's."""
    return _top_zones_in_year(star, "do_zone_key", year, n)


def q05_top_boroughs_by_month(star: Star, n: int | None = None) -> DataFrame:
    n = star.settings.top_per_group if n is None else n
    z = _zone(star, "pu_zone_key", ("borough",))
    agg = (_dated(star).join(z, "pu_zone_key").groupBy("year", "month", "borough")
           .agg(_n().alias("trips")))
    top = _rank_within(agg, ["year", "month"],
                       [nulls_large_desc("trips"), nulls_large_asc("borough")], n)
    return top.orderBy("year", "month", "_rn").select("year", "month", "borough", "trips")


def q06_peak_hours_by_weekday(star: Star, n: int | None = None) -> DataFrame:
    n = star.settings.top_per_group if n is None else n
    agg = (_dated(star).groupBy("day_of_week",
                                F.hour("pickup_ts").cast("int").alias("hour_of_day"))
           .agg(_n().alias("trips")))
    top = _rank_within(agg, ["day_of_week"],
                       [nulls_large_desc("trips"), nulls_large_asc("hour_of_day")], n)
    return top.orderBy("day_of_week", "_rn").select("day_of_week", "hour_of_day", "trips")


def q07_trips_by_weekday(star: Star) -> DataFrame:
    return (_dated(star).groupBy("day_of_week").agg(_n().alias("total_trips"))
            .orderBy(nulls_large_desc("total_trips"), "day_of_week"))


# 2. Revenue, fares, tips --------------------------------------------------------

def q08_revenue_by_month(star: Star) -> DataFrame:
    return (_dated(star).groupBy("year", "month")
            .agg(money_sum("total_amount").alias("total_revenue"))
            .orderBy("year", "month"))


def q09_revenue_by_service_month(star: Star) -> DataFrame:
    s = literal(star.dim_service_type)
    return (_dated(star).join(s, c("service_key") == s.service_id)
            .groupBy("year", "month", "service_type")
            .agg(money_sum("total_amount").alias("total_revenue"))
            .orderBy("year", "month", "service_type"))


def q10_tip_pct_by_month(star: Star) -> DataFrame:
    return (_dated(star).groupBy("year", "month")
            .agg(tip_pct().alias("avg_tip_percentage"))
            .orderBy("year", "month"))


def q11_tip_pct_by_borough_month(star: Star) -> DataFrame:
    z = _zone(star, "pu_zone_key", ("borough",))
    return (_dated(star).join(z, "pu_zone_key").groupBy("year", "month", "borough")
            .agg(tip_pct().alias("avg_tip_percentage"))
            .orderBy("year", "month", nulls_large_asc("borough")))


def q12_top_zones_by_revenue(star: Star, n: int | None = None) -> DataFrame:
    n = star.settings.top_n if n is None else n
    z = _zone(star, "pu_zone_key", ("zone_name",))
    agg = (star.fct.join(z, "pu_zone_key").groupBy("zone_name")
           .agg(money_sum("total_amount").alias("total_revenue")))
    return _top(agg, n, nulls_large_desc("total_revenue"), nulls_large_asc("zone_name"))


def q13_top_zones_by_tip_pct(star: Star, min_trips: int | None = None,
                             n: int | None = None) -> DataFrame:
    min_trips = star.settings.min_trips if min_trips is None else min_trips
    n = star.settings.top_n if n is None else n
    z = _zone(star, "pu_zone_key", ("zone_name",))
    agg = (star.fct.join(z, "pu_zone_key").groupBy("zone_name")
           .agg(_n().alias("total_trips"), tip_pct_exact().alias("avg_tip_pct"))
           .where(c("total_trips") >= min_trips))
    top = _top(agg, n, nulls_large_desc("avg_tip_pct"), nulls_large_asc("zone_name"))
    return top.withColumn("avg_tip_pct", round6("avg_tip_pct"))


def q14_cash_vs_card(star: Star, classes=None) -> DataFrame:
    classes = list(star.settings.payment_classes if classes is None else classes)
    p = literal(star.dim_payment_type.where(c("payment_type").isin(classes)))
    return (star.fct.join(p, "payment_type_key").groupBy("payment_type")
            .agg(_n().alias("total_trips"),
                 money_sum("total_amount").alias("total_revenue"),
                 tip_pct().alias("avg_tip_pct")))


# 3. Duration, distance, speed ------------------------------------------------

def q15_avg_duration_by_month(star: Star) -> DataFrame:
    return (_dated(star).groupBy("year", "month")
            .agg(round6(F.avg(minutes_between("pickup_ts", "dropoff_ts")))
                 .alias("avg_duration_min"))
            .orderBy("year", "month"))


def q16_avg_distance_by_month(star: Star) -> DataFrame:
    return (_dated(star).groupBy("year", "month")
            .agg(round6(F.avg(c("trip_distance").cast("double"))).alias("avg_distance"))
            .orderBy("year", "month"))


def q17_speed_by_borough_hour(star: Star) -> DataFrame:
    z = _zone(star, "pu_zone_key", ("borough",))
    speed = safe_ratio("trip_distance", hours_between("pickup_ts", "dropoff_ts"))
    return (star.fct.join(z, "pu_zone_key")
            .groupBy("borough", F.hour("pickup_ts").cast("int").alias("hour_of_day"))
            .agg(round6(F.avg(speed)).alias("avg_speed_mph"))
            .orderBy(nulls_large_asc("borough"), "hour_of_day"))


def q18_duration_percentiles(star: Star) -> DataFrame:
    z = _zone(star, "pu_zone_key", ("borough",))
    trips = star.fct.join(z, "pu_zone_key")
    p = percentile_cont(trips, ["borough"], minutes_between("pickup_ts", "dropoff_ts"),
                        {"p50_duration_min": 0.5, "p90_duration_min": 0.9})
    return p.select("borough", round6("p50_duration_min").alias("p50_duration_min"),
                    round6("p90_duration_min").alias("p90_duration_min"))


def q19_top_zones_by_p90(star: Star, n: int | None = None) -> DataFrame:
    n = star.settings.top_n if n is None else n
    z = _zone(star, "pu_zone_key", ("zone_name",))
    trips = star.fct.join(z, "pu_zone_key")
    p = percentile_cont(trips, ["zone_name"], minutes_between("pickup_ts", "dropoff_ts"),
                        {"p90_duration_min": 0.9})
    top = _top(p, n, nulls_large_desc("p90_duration_min"), nulls_large_asc("zone_name"))
    return top.select("zone_name", round6("p90_duration_min").alias("p90_duration_min"))


# 4. Routes -------------------------------------------------------------------

def q20_top_routes(star: Star, n: int | None = None) -> DataFrame:
    n = star.settings.top_n if n is None else n
    zones = star.zones()
    pu = zones.select(c("zone_key").alias("pu_zone_key"), c("borough").alias("pickup_borough"))
    do = zones.select(c("zone_key").alias("do_zone_key"), c("borough").alias("dropoff_borough"))
    agg = (star.fct.join(pu, "pu_zone_key").join(do, "do_zone_key")
           .groupBy("pickup_borough", "dropoff_borough").agg(_n().alias("total_trips")))
    return _top(agg, n, nulls_large_desc("total_trips"), nulls_large_asc("pickup_borough"),
                nulls_large_asc("dropoff_borough"))


QUESTIONS = {
    f.__name__: f for f in (
        q01_trips_by_month, q02_trips_by_service_month, q03_top_pickup_zones,
        q04_top_dropoff_zones, q05_top_boroughs_by_month, q06_peak_hours_by_weekday,
        q07_trips_by_weekday, q08_revenue_by_month, q09_revenue_by_service_month,
        q10_tip_pct_by_month, q11_tip_pct_by_borough_month, q12_top_zones_by_revenue,
        q13_top_zones_by_tip_pct, q14_cash_vs_card, q15_avg_duration_by_month,
        q16_avg_distance_by_month, q17_speed_by_borough_hour, q18_duration_percentiles,
        q19_top_zones_by_p90, q20_top_routes,
    )
}
