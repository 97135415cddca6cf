from pyspark.sql import functions as F

from tripmart.operators import checks as K

from rows import bronze, trip, zones


def test_not_null_fails_and_unique_passes_on_sample_model(spark):
    # the sample model: ids {1, NULL}
    df = spark.createDataFrame([(1,), (None,)], "id int")
    assert K.not_null(df, "id").count() == 1
    assert K.unique(df, "id").count() == 0
    # the second sample model keeps id = 1 only: both checks pass
    second = df.where(F.col("id") == 1)
    assert K.not_null(second, "id").count() == 0


def test_relationships_null_child_passes(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in K.relationships(child, "k", parent, "k").collect()] == [9]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("yellow",), (None,), ("red",)], "s string")
    assert [tuple(r) for r in K.accepted_values(df, "s", ["yellow", "green"]).collect()] == [("red", 1)]


def test_key_collision_and_duplicate_trip_reported(spark):
    from tripmart.operators import gold as G
    from tripmart.operators import silver as S

    rows = [trip(pu=1, do=23), trip(pu=12, do=3), trip(pu=5, do=6), trip(pu=5, do=6)]
    z = zones(spark, [(i, "Queens", f"Z{i}") for i in (1, 3, 5, 6, 12, 23)])
    silver = S.silver_trips(bronze(spark, rows), bronze(spark, [], "green"), z)
    fct = G.fct_trips(silver)
    assert fct.count() == 4  # both kept
    dups = sorted(r.row_count for r in K.unique(fct, "trip_key").collect())
    assert dups == [2, 2]


def test_run_checks_summary(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "id int")
    checks = [K.Check("m", "not_null", "id"), K.Check("m", "unique", "id")]
    out = {r.check_name: r.failures for r in K.run_checks(spark, checks, {"m": df}).collect()}
    assert out == {"not_null": 1, "unique": 2}
