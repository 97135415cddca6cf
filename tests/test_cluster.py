"""What must hold away from one machine: submitted masters, other file systems,
missing checkpoint folders, failures midway, dirty input."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmart.operators import bronze as B
from tripmart.operators import gold as G
from tripmart.plans.catalog import layers
from tripmart.sources import landing as L
from tripmart.sources import tables as T

REPO = Path(__file__).resolve().parents[1]


def run_python(code: str, submit: str = "") -> str:
    env = os.environ | {"PYTHONPATH": str(REPO)}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    env.pop("PYSPARK_GATEWAY_SECRET", None)
    if submit:
        env["PYSPARK_SUBMIT_ARGS"] = f"{submit} --conf spark.ui.enabled=false pyspark-shell"
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200).stdout


def test_session_has_the_submitted_master():
    code = ("from tripmart.session import session; s = session(); "
            "print('MASTER', s.sparkContext.master, s.conf.get('spark.sql.ansi.enabled'), "
            "s.conf.get('spark.sql.session.timeZone'))")
    assert "MASTER local[2] true UTC" in run_python(code, "--master local[2]")
    assert "MASTER local[3] true Asia/Tokyo" in run_python(
        code, "--master local[3] --conf spark.sql.session.timeZone=Asia/Tokyo")


def test_no_shared_folder_on_a_cluster_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    from tripmart.session import shared_dir

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_table_exists_asks_the_paths_file_system(spark, tmp_path):
    """A mounted file system: no such folder on the local disk."""
    spark.conf.set("fs.viewfs.mounttable.wh.link./t", f"file://{tmp_path}")
    try:
        path = "viewfs://wh/t/bronze"
        assert not T.table_exists(spark, path)
        df = spark.createDataFrame([(1, "2024-01", "yellow")], "vendorid long, source_month string, service_type string")
        B.load_months(spark, df, path)
        assert T.table_exists(spark, path)
        stats = B.load_months(spark, df.withColumn("brand_new", F.lit(1)), path)
        assert stats["dropped_columns"] == ["brand_new"]
        assert "brand_new" not in spark.read.parquet(path).columns
    finally:
        spark.conf.unset("fs.viewfs.mounttable.wh.link./t")


def test_empty_lookup_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "lookup")
    df = spark.range(3)
    assert T.replace_table(df, path)["rows"] == 3
    assert T.replace_table(df.limit(0), path)["skipped"]
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="broken"):
        T.replace_table(df.select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3


def test_star_is_switched_as_one(spark, tmp_path):
    star = layers(spark, "/root/testdata/sf0.001").star
    path = str(tmp_path / "gold")
    first = G.write_star(spark, star, path, rebalance=True)
    n = first.fct.count()
    bad = G.Star(star.fct.limit(5), star.dim_date, star.dim_zone, star.dim_service_type, star.dim_payment_type,
                 star.dim_vendor.select(F.raise_error(F.lit("broken")).cast("int").alias("vendor_key"), "vendor_name"),
                 star.settings)
    with pytest.raises(Exception, match="broken"):
        G.write_star(spark, bad, path, rebalance=True)
    assert G.read_star(spark, path, star.settings).fct.count() == n


def test_storage_errors_are_raised(spark, tmp_path, monkeypatch):
    """Only a missing or corrupt month file is skipped."""
    (tmp_path / "yellow_tripdata_2024-01.parquet").write_bytes(b"no parquet at all")
    failed = []
    files = [("yellow", "2024-01", str(tmp_path / "yellow_tripdata_2024-01.parquet")),
             ("yellow", "2024-02", str(tmp_path / "yellow_tripdata_2024-02.parquet"))]
    assert B.read_landing_months(spark, files, "yellow", [], failed) is None
    assert sorted(failed) == ["2024-01", "2024-02"]
    with pytest.raises(Exception, match="nosuchscheme"):
        B.read_landing_months(spark, [("yellow", "2024-01", "nosuchscheme://x/yellow_tripdata_2024-01.parquet")], "yellow")


def test_nan_codes_are_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "vendorid double")
    assert [r[0] for r in B.repair_int_columns(df, ["vendorid"]).collect()] == [1, None, None]


def test_csv_quotes(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone\n1,Queens,"Say ""hi"", park"\n2,N/A,"two\nlines"\n')
    rows = {r.locationid: (r.borough, r.zone) for r in L.read_zone_lookup(spark, str(path)).collect()}
    assert rows == {1: ("Queens", 'Say "hi", park'), 2: (None, "two\nlines")}
    out = str(tmp_path / "out")
    T.write_csv(spark.createDataFrame([('Say "hi", park',)], "z string").coalesce(1), out)
    text = "".join(p.read_text() for p in Path(out).glob("part-*"))
    assert '"Say ""hi"", park"' in text
