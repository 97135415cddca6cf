"""Check states by month: only what changed is read, and they add up to the report."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators import checks as K
from tripmart.operators import gold as G
from tripmart.operators import month_checks as M
from tripmart.plans.catalog import layers
from tripmart.sources import versioned as V

SF = "/root/testdata/sf0.001"


def whole(spark, path, star):
    s = G.read_star(spark, path, star.settings)
    models = {"fct_trips": s.fct, "dim_zone": s.dim_zone, "dim_date": s.dim_date}
    return {tuple(r) for r in K.run_checks(spark, M.FACT_CHECKS, models).collect()}


def reported(spark, path):
    return {tuple(r) for r in M.report(spark, path).collect()}


def test_states_follow_the_months(spark, tmp_path):
    star, path = layers(spark, SF).star, str(tmp_path / "gold")
    # failures of every kind: keys held twice, NULL keys, unknown zones and dates
    dirty = star.fct.unionByName(star.fct.where("pu_zone_key % 4 = 0")) \
        .withColumn("do_zone_key", F.when(F.col("do_zone_key") % 5 == 0, -1).otherwise(F.col("do_zone_key"))) \
        .withColumn("trip_key", F.when(F.col("passengers_count") != 3, F.col("trip_key")))
    G.write_star(spark, G.Star(**{**star.__dict__, "fct": dirty}), path, rebalance=True)
    with pytest.raises(ValueError, match="older"):
        M.report(spark, path)
    months = M.refresh_checks(spark, path)
    assert len(months) == len(V.latest(spark, path).of("fct_trips"))
    want = whole(spark, path, star)
    assert reported(spark, path) == want and sum(r[3] > 0 for r in want) >= 3
    assert M.refresh_checks(spark, path) == []

    # one month replaced, one gone
    base = V.latest(spark, path)
    first, second = sorted(base.of("fct_trips"))[2:4]
    month = first.split("=")[1]
    V.commit(spark, path, base, G.write_fact(star.fct.where(F.col("pickup_month") == month), path), drop=[second])
    with pytest.raises(ValueError, match="older"):
        M.report(spark, path)
    assert M.refresh_checks(spark, path) == [month]
    assert reported(spark, path) == whole(spark, path, star) != want


def test_a_changed_parent_is_checked_everywhere(spark, tmp_path):
    star, path = layers(spark, SF).star, str(tmp_path / "gold")
    G.write_star(spark, star, path, rebalance=True)
    M.refresh_checks(spark, path)
    # the same zones written again: nothing to do
    V.commit(spark, path, V.latest(spark, path), V.write(star.dim_zone, path, "dim_zone"))
    assert M.refresh_checks(spark, path) == []
    V.commit(spark, path, V.latest(spark, path), V.write(star.dim_zone.where("zone_key <> 1"), path, "dim_zone"))
    assert len(M.refresh_checks(spark, path)) == len(V.latest(spark, path).of("fct_trips"))
    got = reported(spark, path)
    assert got == whole(spark, path, star)
    assert {r[2] for r in got if r[3]} >= {"pu_zone_key", "do_zone_key"}
