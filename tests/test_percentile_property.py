"""Property test: histogram percentiles equal numpy's linear interpolation."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.operators import percentiles as P

values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.lists(values, min_size=1, max_size=4),
       p=st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_percentile_cont_equals_numpy(spark, groups, p):
    rows = [(i, v) for i, vs in enumerate(groups) for v in vs]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.q for r in P.percentile_cont(df, ["g"], F.col("v"), {"q": p}).collect()}
    for i, vs in enumerate(groups):
        clean = [v for v in vs if v is not None]
        want = float(np.quantile(clean, p)) if clean else None
        assert (got[i] is None and want is None) or abs(got[i] - want) < 1e-9, (vs, p, got[i])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vs=st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_upper_median_is_sorted_at_half(spark, vs):
    df = spark.createDataFrame([(v,) for v in vs], "v int")
    got = P.upper_median(df, [], F.col("v"), "m").first().m
    assert got == sorted(vs)[len(vs) // 2]
