"""Physical plan shape over a written star: what must hold at any scale."""

import contextlib
import io

import pytest

from tripmart.config import TESTDATA
from tripmart.operators import gold as G
from tripmart.plans import questions as Q
from tripmart.plans.catalog import layers

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star"))
    s = G.write_star(spark, layers(spark, SF, TESTDATA).star, path, rebalance=True)
    s.zones()
    return s


def test_year_filter_prunes_month_partitions(star):
    p = plan_of(Q.q01_trips_by_month(star))
    assert "dynamicpruningexpression(pickup_month" in p
    assert "SortMergeJoin" not in p


def test_dimension_joins_are_broadcast(star):
    for q in (Q.q20_top_routes, Q.q11_tip_pct_by_borough_month, Q.q14_cash_vs_card):
        p = plan_of(q(star))
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p, q.__name__


def test_top_k_is_take_ordered(star):
    for q in (Q.q03_top_pickup_zones, Q.q12_top_zones_by_revenue, Q.q20_top_routes):
        assert "TakeOrderedAndProject" in plan_of(q(star)), q.__name__


def test_fact_scan_reads_only_needed_columns(star):
    p = plan_of(Q.q08_revenue_by_month(star))
    assert "ReadSchema: struct<pickup_date_key:int,total_amount:decimal(10,2)>" in p


def test_percentile_reduces_before_window(star):
    from pyspark.sql import functions as F

    from tripmart.operators import percentiles as P

    # the histogram is a combinable count: partial counts before its shuffle
    hist = plan_of(P._histogram(star.fct, ["pu_zone_key"], F.col("trip_distance")))
    assert hist.index("partial_count(1)") > hist.index("Exchange hashpartitioning")
    # the ranks come from the written histogram: the fact is scanned by the one
    # job that writes it
    p = plan_of(Q.q18_duration_percentiles(star))
    assert "fct_trips" not in p and "histogram" in p


def test_top_per_group_uses_group_limit(star):
    p = plan_of(Q.q05_top_boroughs_by_month(star))
    assert "WindowGroupLimit" in p or "row_number()" in p


def test_silver_filters_below_joins_and_prunes_scan(spark):
    p = plan_of(layers(spark, SF, TESTDATA).silver)
    assert "SortMergeJoin" not in p
    assert "l_comment" not in p and "l_receiptdate" not in p


def test_map_only_fact_write_has_no_exchange(spark):
    fct = layers(spark, SF, TESTDATA).star.fct
    assert "Exchange hashpartitioning" not in plan_of(fct)
