"""Hand fixtures for question semantics the generated data does not show."""

import datetime as dt

import pytest

from tripmart.config import REFERENCE
from tripmart.operators import gold as G
from tripmart.operators import silver as S
from tripmart.plans import questions as Q

from rows import bronze, trip, zones


def star_of(spark, rows, zone_rows, green_rows=()):
    z = zones(spark, zone_rows)
    silver = S.silver_trips(bronze(spark, list(rows)), bronze(spark, list(green_rows), "green"), z)
    return G.build_star(spark, silver, z, REFERENCE)


def test_null_ranks_first_in_tip_pct_top(spark):
    rows = [trip(pu=1, fare=0.0, tip=1.0) for _ in range(100)]
    rows += [trip(pu=2, fare=10.0, tip=5.0) for _ in range(100)]
    rows += [trip(pu=3, fare=10.0, tip=1.0) for _ in range(99)]  # below the minimum
    star = star_of(spark, rows, [(1, "Queens", "Zero"), (2, "Queens", "Half"), (3, "Bronx", "Few")])
    out = Q.q13_top_zones_by_tip_pct(star).collect()
    assert [(r.zone_name, r.avg_tip_pct) for r in out] == [("Zero", None), ("Half", 50.0)]


def test_ranks_before_rounding(spark):
    """Two zones that differ only beyond the sixth place: the exact value decides."""
    rows = [trip(pu=1, fare=50_000_000.0, tip=10.00, total=60_000_000.0) for _ in range(100)]
    rows += [trip(pu=2, fare=50_000_000.0, tip=10.05, total=60_000_000.0) for _ in range(100)]
    star = star_of(spark, rows, [(1, "Queens", "A lower"), (2, "Queens", "B higher")])
    out = Q.q13_top_zones_by_tip_pct(star, n=1).collect()
    assert [(r.zone_name, r.avg_tip_pct) for r in out] == [("B higher", 0.00002)]
    rows = [trip(pu=1, dropoff="2024-01-01 08:30:00")] * 3 + [trip(pu=2, dropoff="2024-01-01 08:30:00.000010")] * 3
    star = star_of(spark, rows, [(1, "Queens", "A lower"), (2, "Queens", "B higher")])
    out = Q.q19_top_zones_by_p90(star, n=1).collect()
    assert [(r.zone_name, r.p90_duration_min) for r in out] == [("B higher", 30.0)]


def test_tie_at_top_k_cut_keeps_smaller_name(spark):
    rows = [trip(pu=1)] * 3 + [trip(pu=2)] * 2 + [trip(pu=3)] * 2
    star = star_of(spark, rows, [(1, "Q", "A"), (2, "Q", "C"), (3, "Q", "B")])
    out = Q.q12_top_zones_by_revenue(star, n=2).collect()
    assert [r.zone_name for r in out] == ["A", "B"]


def test_null_zone_name_is_a_group(spark):
    rows = [trip(pu=1), trip(pu=1), trip(pu=2)]
    star = star_of(spark, rows, [(1, "Q", None), (2, "Q", "Named")])
    out = {r.zone_name: r.total_revenue for r in Q.q12_top_zones_by_revenue(star).collect()}
    assert set(out) == {None, "Named"}


def test_bad_rows_dropped_and_zero_duration_left_out_of_speed(spark):
    rows = [
        trip(pickup="2024-01-01 08:00:00", dropoff="2024-01-01 09:00:00", distance=30.0),
        trip(pickup="2024-01-01 08:00:00", dropoff="2024-01-01 08:00:00", distance=5.0),
        trip(total=None), trip(distance=None), trip(total=-1.0), trip(pickup=None),
        trip(pickup="2024-01-01 09:00:00", dropoff="2024-01-01 08:00:00"),
    ]
    star = star_of(spark, rows, [(1, "Queens", "A"), (2, "Queens", "B")])
    assert star.fct.count() == 2
    out = Q.q17_speed_by_borough_hour(star).collect()
    assert [(r.borough, r.hour_of_day, r.avg_speed_mph) for r in out] == [("Queens", 8, 30.0)]


def test_unknown_codes_map_to_last_key(spark):
    rows = [trip(vendor=v, payment=p) for v, p in
            ((1, 1), (2, 2), (None, 0), (7, 3), (None, 4), (3, None))]
    star = star_of(spark, rows, [(1, "Q", "A"), (2, "Q", "B")])
    keys = sorted((r.vendor_key, r.payment_type_key) for r in star.fct.collect())
    assert keys == [(1, 1), (2, 2), (3, 3), (3, 3), (3, 3), (3, 3)]


def test_calendar_and_weekday_questions(spark):
    rows = [trip(pickup="2024-01-07 10:00:00", dropoff="2024-01-07 10:10:00"),
            trip(pickup="2024-01-01 23:00:00", dropoff="2024-01-01 23:30:00"),
            trip(pickup="2027-01-01 10:00:00", dropoff="2027-01-01 10:10:00")]  # outside calendar
    star = star_of(spark, rows, [(1, "Q", "A"), (2, "Q", "B")])
    assert {(r.day_of_week, r.total_trips) for r in Q.q07_trips_by_weekday(star).collect()} == {(7, 1), (1, 1)}
    assert [tuple(r) for r in Q.q01_trips_by_month(star, 2024).collect()] == [(1, 2)]
    # questions without the calendar count the trip outside it
    assert Q.q20_top_routes(star).first().total_trips == 3


def test_percentiles_and_durations(spark):
    rows = [trip(pickup="2024-01-01 08:00:00", dropoff=f"2024-01-01 08:{m:02d}:00") for m in (10, 20, 30, 40)]
    star = star_of(spark, rows, [(1, "Queens", "A"), (2, "Queens", "B")])
    r = Q.q18_duration_percentiles(star).first()
    assert (r.p50_duration_min, r.p90_duration_min) == (25.0, 37.0)
    assert Q.q15_avg_duration_by_month(star).first().avg_duration_min == 25.0


def test_cash_vs_card(spark):
    rows = [trip(payment=1, fare=10.0, tip=2.0, total=12.0), trip(payment=2, fare=10.0, tip=0.0, total=10.0),
            trip(payment=3, total=5.0)]
    star = star_of(spark, rows, [(1, "Q", "A"), (2, "Q", "B")])
    out = {r.payment_type: (r.total_trips, float(r.total_revenue), r.avg_tip_pct)
           for r in Q.q14_cash_vs_card(star).collect()}
    assert out == {"card": (1, 12.0, 20.0), "cash": (1, 10.0, 0.0)}
