import datetime as dt

from pyspark.sql import functions as F

from tripmart.functions import columns as C


def test_iso_day_of_week_monday_one_sunday_seven(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 1),)], "d date")
    got = [r[0] for r in df.select(C.iso_day_of_week("d")).collect()]
    assert got == [7, 1]


def test_date_key_is_yyyymmdd(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 23, 59),)], "t timestamp_ntz")
    assert df.select(C.date_key("t")).first()[0] == 20240309


def test_trip_key_collides_without_delimiter(spark):
    t = dt.datetime(2024, 1, 1, 8, 0)
    df = spark.createDataFrame([("yellow", t, t, 1, 23), ("yellow", t, t, 12, 3)],
                               "s string, a timestamp_ntz, b timestamp_ntz, pu int, do int")
    keys = [r[0] for r in df.select(C.trip_key("s", "a", "b", "pu", "do")).collect()]
    assert keys[0] == keys[1]


def test_minutes_and_safe_ratio(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 8, 1, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(C.minutes_between("a", "b").alias("m"), C.hours_between("a", "a").alias("h"),
                  C.safe_ratio(F.lit(1), F.lit(0)).alias("q")).first()
    assert r.m == 1.5 and r.h == 0.0 and r.q is None


def test_month_text_and_suffix(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 15),)], "d date")
    r = df.select(C.month_text("d"), C.partition_suffix("d"), C.month_start("d")).first()
    assert tuple(r) == ("2022-01", "2022_01", dt.date(2022, 1, 1))


def test_money_cast_rounds_half_up(spark):
    # H1: double -> decimal(10,2) rounds half up in Spark (1.005 -> 1.01); the
    # oracle data only has two-decimal values, so both engines agree there
    df = spark.createDataFrame([(1.005,), (2.5,), (-1.005,)], "x double")
    got = [str(r[0]) for r in df.select(F.col("x").cast(C.MONEY)).collect()]
    assert got == ["1.01", "2.50", "-1.01"]


def test_durations_ignore_session_zone_dst(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("""select * from values
          (timestamp_ntz'1999-04-04 02:50:00', timestamp_ntz'1999-04-04 03:10:00'),
          (timestamp_ntz'1999-04-04 01:50:00', timestamp_ntz'1999-04-04 02:20:00'),
          (timestamp_ntz'1999-10-31 01:50:00', timestamp_ntz'1999-10-31 02:10:00.5') as t(a, b)""")
        got = [r[0] for r in df.select(C.duration_micros("a", "b")).collect()]
        assert got == [1_200_000_000, 1_800_000_000, 1_200_500_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
