"""Duplicates by sketch: exact, and little to shuffle."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.operators import checks as K
from tripmart.operators import duplicates as D



@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**60), max_size=50))
def test_coding_round_trip(values):
    h = np.sort(np.array(values, np.int64))
    for width in (60, 61, 62):
        assert D.decode(D.encode(h, width + 1)).tolist() == h.tolist()
    small = np.sort(h % 50)
    assert D.decode(D.encode(small, 6)).tolist() == small.tolist()


def test_same_duplicates_as_a_count(spark, monkeypatch):
    rnd = random.Random(2)
    values = [f"{rnd.getrandbits(64):016x}" for _ in range(20_000)]
    values += values[:40] + ["00ff"] * 900 + [None] * 500 + ["", ""]
    rnd.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(7).cache()
    want = sorted(map(tuple, K.unique(df, "k").collect()))
    assert len(want) == 42
    monkeypatch.setattr(D, "TASK_ROWS", 1500)     # several sketches a task
    monkeypatch.setattr(D, "RANGE_ROWS", 1000)    # many ranges
    assert sorted(map(tuple, K.unique_by_sketch(df, "k").collect())) == want
    assert sorted(map(tuple, K.unique_by_sketch(df, "k", hexadecimal=True).collect())) == sorted(
        map(tuple, K.unique(df, "k", hexadecimal=True).collect()))
    # more possible duplicates than may be broadcast: the plain count
    assert sorted(map(tuple, D.duplicates(df, F.col("k"), max_broadcast_rows=3).collect())) == want
    assert D.duplicates(df.limit(0), F.col("k")).count() == 0
    numbers = spark.createDataFrame([(i % 90,) for i in range(100)], "k bigint")
    assert {r.value for r in D.duplicates(numbers, F.col("k")).collect()} == set(range(10))


def _shuffled(spark, run) -> int:
    """Bytes that the stages of a run write to shuffles, by the status store."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in _stages(spark, store)}
    run()
    return sum(s.shuffleWriteBytes() for s in _stages(spark, store) if s.stageId() not in before)


def _stages(spark, store):
    seq = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return [seq.apply(i) for i in range(seq.size())]


def test_a_tenth_of_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(0, 400_000, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    plain = _shuffled(spark, lambda: K.unique(df, "k", hexadecimal=True).count())
    sketch = _shuffled(spark, lambda: K.unique_by_sketch(df, "k", True, 400_000).count())
    print("shuffled", plain, sketch)
    assert 0 < sketch <= plain / 10
