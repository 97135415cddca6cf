"""End-to-end refresh from Spark-written landing month folders."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart.config import TESTDATA
from tripmart.plans import questions as Q
from tripmart.plans.catalog import layers
from tripmart.sources import fixtures
from tripmart.sources import landing as L
from tripmart.warehouse import refresh

SF = "/root/testdata/sf0.001"
MONTHS = ("1998-01", "1998-02", "1998-03")


def test_refresh_end_to_end(spark, tmp_path):
    land = fixtures.landing(spark, SF)
    landing_dir = tmp_path / "landing"
    for svc, df in (("yellow", land.yellow), ("green", land.green)):
        for m in MONTHS:
            (df.where(F.col("source_month") == m).drop("source_month")
             .write.parquet(str(landing_dir / L.trip_file_name(svc, m))))
    settings = TESTDATA.with_(plan_start=dt.date(1997, 12, 1), plan_end=dt.date(1998, 3, 31))
    root = str(tmp_path / "wh")
    out = refresh(spark, str(landing_dir), land.zones, root, settings)
    cov = {(r.year_month, r.service_type): r.status for r in out.coverage.collect()}
    assert cov[("1997-12", "yellow")] == "missing"
    assert all(cov[(m, s)] == "loaded" for m in MONTHS for s in ("yellow", "green"))

    lazy = layers(spark, SF).silver.where(F.col("source_month").isin(list(MONTHS)))
    assert out.star.fct.count() == lazy.count()
    fails = {(c["model"], c["check_name"], c["column_name"]): c["failures"] for c in out.checks}
    assert fails[("fct_trips", "unique", "trip_key")] == 0
    assert fails[("silver_trips", "not_null", "pickup_ts")] == 0

    # a second refresh replaces the months instead of adding to them
    again = refresh(spark, str(landing_dir), land.zones, root, settings, run_checks=False)
    assert again.star.fct.count() == lazy.count()
    got = {tuple(r) for r in Q.q02_trips_by_service_month(again.star).collect()}
    assert sum(r[3] for r in got) > 0
