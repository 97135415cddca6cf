"""Percentiles by summary and bracket: only the brackets are counted exactly."""

import random

import pytest
from pyspark.sql import functions as F

from tripmart.operators import percentiles as P

INF, NAN = float("inf"), float("nan")


def test_cells_rise_with_values(spark):
    rnd = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, INF, -INF, 1.0, -1.0]
    values += [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(500)]
    values += [x + d for x in (1.0, 24.0, 1e9) for d in (0.0, 1e-7, 1e-4)]
    df = spark.createDataFrame([(v,) for v in values], "v double").orderBy("v")
    cells = [r[0] for r in df.select(P.cell(F.col("v"))).collect()]
    assert cells == sorted(cells) and len(set(cells)) > 400
    top = spark.createDataFrame([(NAN,), (INF,)], "v double").select(P.cell(F.col("v"))).collect()
    assert top[0][0] > top[1][0]
    for ddl in ("bigint", "decimal(20,6)", "int"):
        ints = spark.range(-300, 300).select(F.col("id").cast(ddl).alias("v")).orderBy("v")
        cells = [r[0] for r in ints.select(P.cell(F.col("v"))).collect()]
        assert cells == sorted(cells)


def written(spark, monkeypatch):
    paths = []
    real = P.new_table_path

    def note(s, name):
        paths.append((name, real(s, name)))
        return paths[-1][1]

    monkeypatch.setattr(P, "new_table_path", note)
    return paths


def test_only_brackets_are_written(spark, monkeypatch):
    """A hot group of distinct values: two percentiles, two cells, under a fiftieth of them."""
    paths = written(spark, monkeypatch)
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("g"),
                                     (F.rand(5) * 3000).alias("v"))
    df = spark.createDataFrame(df.toPandas()).cache()  # rand differs between the passes otherwise
    got = {r.g: (r.p50, r.p90) for r in P.percentile_cont(df, ["g"], F.col("v"), {"p50": 0.5, "p90": 0.9}).collect()}
    ref = {r.g: (r.p50, r.p90) for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("p50"),
                                                           F.percentile("v", 0.9).alias("p90")).collect()}
    assert all(got[g] == pytest.approx(ref[g], abs=1e-9) for g in ref) and len(got) == 51
    sizes = {name: spark.read.parquet(path).count() for name, path in paths}
    assert set(sizes) == {"brackets", "histogram"}
    assert sizes["brackets"] <= 4 * 51 and sizes["histogram"] < 200_000 / 50


@pytest.mark.parametrize("limit", [0, P.ONE_TASK_ROWS])
def test_values_in_one_cell(spark, monkeypatch, limit):
    """A narrow range is one cell; its values are dealt out in ranges beyond the limit."""
    monkeypatch.setattr(P, "ONE_TASK_ROWS", limit)
    paths = written(spark, monkeypatch)
    rows = [("a", 1e9 + i % 997) for i in range(5000)] + [("b", None)] + [("c", 1e9)] * 30 + [(None, -1e9 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range again
    try:
        got = {r.g: r.p for r in P.percentile_cont(df, ["g"], F.col("v"), {"p": 0.73}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ref = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", 0.73).alias("p")).collect()}
    assert got == pytest.approx(ref, abs=1e-6) and got["b"] is None
    histogram = spark.read.parquet(next(path for name, path in paths if name == "histogram"))
    assert ("_part" in histogram.columns and histogram.select("_part").distinct().count() > 1) == (limit == 0)


def test_no_broadcast_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    df = spark.range(2000).select((F.col("id") % 7).alias("g"), (F.col("id") * 1.5).alias("v"))
    got = {r.g: r.m for r in P.upper_median(df, ["g"], F.col("v"), "m").collect()}
    for g in range(7):
        values = [i * 1.5 for i in range(2000) if i % 7 == g]
        assert got[g] == values[len(values) // 2]


def test_special_values_and_empty_input(spark):
    df = spark.createDataFrame([(v,) for v in (NAN, 1.0, INF, -INF, 0.0, -0.0, None)], "v double")
    at = {str(p): P.percentile_disc(df, [], F.col("v"), {"q": p}).first().q for p in (0.0, 0.5, 0.8)}
    assert at["0.0"] == -INF and at["0.5"] == 0.0 and at["0.8"] == INF
    assert str(P.percentile_disc(df, [], F.col("v"), {"q": 1.0}).first().q) == "nan"
    empty = df.limit(0)
    assert P.upper_median(empty, [], F.col("v"), "m").collect()[0].m is None
    assert P.percentile_cont(empty.withColumn("g", F.lit(1)), ["g"], F.col("v"), {"q": 0.5}).count() == 0
