"""Month files that disagree: types widen whatever their order; footers in one job."""

import decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators import bronze as B
from tripmart.sources import landing as L


def month_file(folder, month, fare, **more):
    folder.mkdir(exist_ok=True)
    df = pd.DataFrame({"VendorID": [1, 2], "tpep_pickup_datetime": pd.Timestamp(f"{month}-02 08:00"),
                       "tpep_dropoff_datetime": pd.Timestamp(f"{month}-02 09:00"), "fare_amount": fare, **more})
    path = folder / L.trip_file_name("yellow", month)
    df.to_parquet(path, index=False, coerce_timestamps="us")
    return ("yellow", month, str(path))


def types(*ddl):
    return [StructType.fromDDL(f"x {d}")[0].dataType for d in ddl]


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("decimal(38,10)", "bigint", "decimal(38,10)"), ("decimal(38,25)", "bigint", "double"), ("decimal(10,2)", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("void", "int", "int"), ("string", "bigint", "string"), ("boolean", "int", "string")])
def test_widest(spark, a, b, want):
    x, y = types(a, b)  # DDL needs a session
    assert B.widest(x, y).simpleString() == B.widest(y, x).simpleString() == want


def test_widest_file_comes_last(spark, tmp_path):
    files = [month_file(tmp_path / "l", "2024-01", [7, 9]),
             month_file(tmp_path / "l", "2024-02", [decimal.Decimal("7.25"), decimal.Decimal("8.50")]),
             month_file(tmp_path / "l", "2024-03", [1.125, None])]
    df = B.read_landing_months(spark, files, "yellow")
    assert df.schema["fare_amount"].dataType.simpleString() == "double"
    got = sorted((r.source_month, r.fare_amount) for r in df.where("fare_amount IS NOT NULL").collect())
    assert got == [("2024-01", 7.0), ("2024-01", 9.0), ("2024-02", 7.25), ("2024-02", 8.5), ("2024-03", 1.125)]
    without = B.read_landing_months(spark, files[:2], "yellow")
    assert without.schema["fare_amount"].dataType.simpleString().startswith("decimal")
    assert {r[0] for r in without.select("fare_amount").collect()} == {7, 9, decimal.Decimal("7.25"), decimal.Decimal("8.5")}


def test_columns_of_the_first_file(spark, tmp_path):
    files = [month_file(tmp_path / "l", "2024-01", [7.0, 9.0], Airport_fee=[1.0, 2.0]),
             month_file(tmp_path / "l", "2024-02", [7.0, 9.0], surcharge=[1, 2])]
    dropped = []
    df = B.read_landing_months(spark, files, "yellow", dropped)
    assert dropped == ["surcharge"] and "surcharge" not in df.columns
    assert {(r.source_month, r.airport_fee) for r in df.collect()} == {("2024-01", 1.0), ("2024-01", 2.0), ("2024-02", None)}


def test_a_broken_file_among_good_ones(spark, tmp_path):
    files = [month_file(tmp_path / "l", f"2024-0{m}", [7.0, 9.0]) for m in (1, 2, 3)]
    (tmp_path / "l" / L.trip_file_name("yellow", "2024-02")).write_bytes(b"no parquet")
    failed = []
    df = B.read_landing_months(spark, files, "yellow", [], failed)
    assert failed == ["2024-02"] and {r[0] for r in df.select("source_month").distinct().collect()} == {"2024-01", "2024-03"}


def test_a_thousand_footers_in_one_job(spark, tmp_path):
    first = month_file(tmp_path / "l", "1900-01", [7.0, 9.0])
    raw = open(first[2], "rb").read()
    files = []
    for i in range(1000):
        month = f"{1900 + i // 12}-{i % 12 + 1:02d}"
        path = tmp_path / "l" / L.trip_file_name("yellow", month)
        path.write_bytes(raw)
        files.append(("yellow", month, str(path)))
    spark.sparkContext.setJobGroup("footers", "footers")
    df = B.read_landing_months(spark, files, "yellow")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext.setJobGroup("other", "other")
    # one job of all footers, one of the first file's; two may list the paths
    assert len(jobs) <= 4
    assert df.select(F.count_distinct("source_month")).first()[0] == 1000
