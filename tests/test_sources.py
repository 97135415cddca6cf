from tripmart.sources import landing as L
from tripmart.sources import tables as T


def test_zone_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "zones.csv"
    p.write_text('LocationID,Borough,Zone,service_zone\n'
                 '1,EWR,Newark Airport,EWR\n'
                 '2,N/A,NA,Boro Zone\n'
                 '3,,"",Yellow Zone\n'
                 '4,Unknown,Queens,N/A\n')
    z = L.read_zone_lookup(spark, str(p))
    rows = {r.locationid: r for r in z.collect()}
    assert rows[2].borough is None and rows[2].zone is None
    assert rows[3].borough is None and rows[3].zone is None
    assert rows[4].borough == "Unknown" and rows[4].service_zone is None
    assert dict(z.dtypes)["locationid"] == "bigint"


def test_csv_sample_round_trip(spark, tmp_path):
    from tripmart.operators import impute as I

    p = tmp_path / "sample.csv"
    p.write_text("PassengerId,Survived,Pclass,Age,SibSp,Parch,Fare\n"
                 "1,0,3,22,1,0,7.25\n2,1,1,,1,0,71.28\n3,1,3,26,0,0,7.92\n4,1,1,35,1,0,53.1\n")
    schema = "PassengerId int, Survived int, Pclass int, Age double, SibSp int, Parch int, Fare double"
    df = L.read_csv(spark, str(p), schema)
    cols = ["Age", "Fare", "Parch", "Pclass", "SibSp", "Survived"]
    clean = I.median_fill(df.select(*cols), cols)
    assert [r.Age for r in clean.collect()] == [22.0, 26.0, 26.0, 35.0]
    out = str(tmp_path / "clean_csv")
    T.write_csv(clean, out)
    back = L.read_csv(spark, out, ", ".join(f"{c} double" for c in cols))
    assert back.count() == 4


def test_preview_and_table_exists(spark, tmp_path):
    df = spark.range(5000)
    assert T.preview(df).count() == 1000
    path = str(tmp_path / "t")
    assert not T.table_exists(spark, path)
    stats = T.write_table(df, path)
    assert stats["rows"] == 5000 and T.table_exists(spark, path)


def test_list_partition_rejects_unknown_value(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, "yellow"), (3, "red")], "service_id int, service_type string")
    with pytest.raises(Exception, match="outside the list partitions"):
        T.write_table(df, str(tmp_path / "svc"), partition_by=("service_type",),
                      accepted={"service_type": ["yellow", "green"]})


def test_bucketed_zone_table(spark, tmp_path):
    df = spark.range(20).selectExpr("cast(id as int) zone_key", "cast(id as string) zone_name")
    T.save_bucketed(df, "dim_zone_bucketed_test", 4, "zone_key", str(tmp_path / "zb"))
    assert spark.table("dim_zone_bucketed_test").count() == 20
    spark.sql("DROP TABLE dim_zone_bucketed_test")


def test_named_table_full_replace_creates_schema(spark, tmp_path):
    df = spark.range(5).selectExpr("cast(id as int) payment_type_key", "'x' payment_type")
    stats = T.save_table(df, "gold_test.dim_payment_type", path=str(tmp_path / "pt"))
    assert stats["rows"] == 5
    T.save_table(df.limit(2), "gold_test.dim_payment_type", path=str(tmp_path / "pt"))
    assert spark.table("gold_test.dim_payment_type").count() == 2
    spark.sql("DROP TABLE gold_test.dim_payment_type")
    spark.sql("DROP DATABASE gold_test")
