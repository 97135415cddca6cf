from pyspark.sql import functions as F

from tripmart.operators import impute as I
from tripmart.operators import percentiles as P


def test_upper_median_fills_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,), (9,)], "x int")
    out = [r.x for r in I.median_fill(df, ["x"]).collect()]
    assert out == [1, 2, 4, 4, 9]


def test_upper_median_even_count_takes_upper(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert I.fit_medians(df, ["x"]) == {"x": 3.0}


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    out = I.median_fill(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [None, None]
    assert [r.b for r in out] == [1.0, 1.0]


def test_several_columns_one_pass_keep_types(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None), (None, 2.5), (4, 3.5)], "a int, b double")
    row = I.upper_median_row(df, ["a", "b"]).first()
    assert row.a == 2 and row.b == 2.5
    assert dict(I.upper_median_row(df, ["a", "b"]).dtypes) == {"a": "int", "b": "double"}


def test_percentile_cont_matches_builtin(spark):
    import random

    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    rows += [(f"g{i % 7}", rnd.random() * 100) for i in range(700)]
    rows += [("single", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    mine = {r.g: (r.p50, r.p90) for r in
            P.percentile_cont(df, ["g"], F.col("v"), {"p50": 0.5, "p90": 0.9}).collect()}
    ref = {r.g: (r.p50, r.p90) for r in df.groupBy("g").agg(
        F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.9).alias("p90")).collect()}
    assert mine.keys() == ref.keys()
    for k in ref:
        for a, b in zip(mine[k], ref[k]):
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, mine[k], ref[k])


def test_percentile_disc_descending_is_upper_median(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], "v int")
    r = P.percentile_disc(df, [], F.col("v"), {"m": 0.5}, descending=True).first()
    assert r.m == 3


def test_percentile_null_group_kept(spark):
    rows = [(None, float(v)) for v in range(10)] + [("a", 1.0), ("a", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.p for r in P.percentile_cont(df, ["g"], F.col("v"), {"p": 0.5}).collect()}
    assert got == {None: 4.5, "a": 2.0}


def test_split_of_a_hot_group_is_exact_and_even(spark):
    import random

    rnd = random.Random(3)
    rows = [("hot", rnd.random()) for _ in range(4000)] + [("cold", float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.p for r in P.percentile_cont(df, ["g"], F.col("v"), {"p": 0.9}).collect()}
    ref = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", 0.9).alias("p")).collect()}
    assert got.keys() == ref.keys()
    assert all(abs(got[k] - ref[k]) < 1e-12 for k in ref)


def test_medians_are_values_of_their_columns(spark):
    from decimal import Decimal

    big, fine = 2**60 + 1, Decimal("0.123456789012")
    df = spark.createDataFrame([(big, 0.5, fine), (None, None, None)], "a bigint, b double, c decimal(20,12)")
    assert I.fit_medians(df, ["a", "b", "c"]) == {"a": big, "b": 0.5, "c": fine}
