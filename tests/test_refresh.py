"""Refresh by changed months, the load ledger, and small files made few."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart.config import TESTDATA
from tripmart.operators import bronze as B
from tripmart.operators import gold as G
from tripmart.plans.catalog import layers
from tripmart.sources import fixtures
from tripmart.sources import landing as L
from tripmart.sources import versioned as V
from tripmart.warehouse import refresh

SF = "/root/testdata/sf0.001"
MONTHS = ("1998-01", "1998-02", "1998-03")
SETTINGS = TESTDATA.with_(plan_start=dt.date(1998, 1, 1), plan_end=dt.date(1998, 3, 31))


def deliver(land, folder, service, month, df=None):
    df = land.yellow if service == "yellow" and df is None else land.green if df is None else df
    df.where(F.col("source_month") == month).drop("source_month").write.mode("overwrite").parquet(
        f"{folder}/{L.trip_file_name(service, month)}")


def later(df, months=1):
    for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        df = df.withColumn(c, F.col(c) + F.expr(f"interval {months} month"))
    return df


def rows(fct):
    return sorted(map(str, fct.select(*G.FACT_COLUMNS).collect()))


@pytest.fixture
def landed(spark, tmp_path):
    land, folder = fixtures.landing(spark, SF), str(tmp_path / "landing")
    for service in ("yellow", "green"):
        for m in MONTHS:
            deliver(land, folder, service, m)
    return land, folder, str(tmp_path / "wh")


def run(spark, landed, settings=SETTINGS, zones=None, root=None):
    land, folder, wh = landed
    return refresh(spark, folder, land.zones if zones is None else zones, root or wh, settings, run_checks=False)


def test_refresh_rewrites_the_months_a_change_touches(spark, landed, tmp_path):
    land, folder, wh = landed
    first = run(spark, landed)
    assert first.loads["fct_trips"]["full"]
    runs = {k: p["run"] for k, p in V.latest(spark, f"{wh}/gold").of("fct_trips").items()}
    assert run(spark, landed).loads["fct_trips"] == {"rows": 0, "months": [], "full": False}

    # February comes with half its trips dated in March: both months, no more
    half = F.col("PULocationID") % 2 == 0
    deliver(land, folder, "yellow", "1998-02", later(land.yellow.where(half)).unionByName(land.yellow.where(~half)))
    again = run(spark, landed)
    assert again.loads["yellow"]["months"] == ["1998-02"] and again.loads["green"]["unchanged_months"] == 3
    assert again.loads["fct_trips"]["months"] == ["1998-02-01", "1998-03-01"]
    now = {k: p["run"] for k, p in V.latest(spark, f"{wh}/gold").of("fct_trips").items()}
    january = "fct_trips/pickup_month=1998-01-01"
    assert now[january] == runs[january] and all(now[k] != runs[k] for k in now if k != january)
    whole = run(spark, landed, root=str(tmp_path / "other"))
    assert rows(again.star.fct) == rows(whole.star.fct)
    assert again.loads["fct_trips"]["rows"] == again.star.fct.where("pickup_month > DATE '1998-01-01'").count()

    # and back again: the trips that had gone to March leave it
    deliver(land, folder, "yellow", "1998-02")
    back = run(spark, landed)
    assert rows(back.star.fct) == rows(first.star.fct)
    # a late month that nothing else falls into goes as a whole
    deliver(land, folder, "yellow", "1998-01", later(land.yellow, 5))
    assert run(spark, landed).loads["fct_trips"]["months"] == ["1998-01-01", "1998-06-01"]
    deliver(land, folder, "yellow", "1998-01")
    run(spark, landed)
    assert "fct_trips/pickup_month=1998-06-01" not in V.latest(spark, f"{wh}/gold").parts


def test_refresh_completes_one_that_failed_between_its_commits(spark, landed, monkeypatch):
    land, folder, _ = landed
    run(spark, landed)
    deliver(land, folder, "yellow", "1998-02", land.yellow.where("PULocationID % 2 = 0"))
    real = G.write_fact

    def fails(*args):
        raise OSError("no space")

    monkeypatch.setattr(G, "write_fact", fails)
    with pytest.raises(OSError):
        run(spark, landed)
    monkeypatch.setattr(G, "write_fact", real)
    again = run(spark, landed)
    assert again.loads["yellow"]["months"] == [] and again.loads["fct_trips"]["months"] == ["1998-02-01"]
    assert again.star.fct.count() == layers(spark, SF).silver.where(
        F.col("source_month").isin(*MONTHS) & ((F.col("source_month") != "1998-02") | (F.col("service_type") == "green")
                                               | (F.col("pickup_location_id") % 2 == 0))).count()


def test_another_lookup_rebuilds_everything(spark, landed):
    land = landed[0]
    run(spark, landed)
    fewer = run(spark, landed, zones=land.zones.where("LocationID > 2"))
    assert fewer.loads["fct_trips"]["full"]
    assert fewer.star.fct.where("pu_zone_key <= 2").count() == 0
    assert run(spark, landed, SETTINGS.with_(calendar_end=dt.date(2002, 1, 31))).loads["fct_trips"]["full"]


def test_two_loads_of_one_month(spark, landed, tmp_path, monkeypatch):
    """The one that started first and ends last loses, and leaves no rows."""
    land, folder, _ = landed
    plan = L.load_plan(spark, "1998-01-01", "1998-03-31")
    files = L.planned_fingerprints(spark, plan, folder)
    path = str(tmp_path / "yellow")
    write = V.write

    def slower(*args, **how):
        monkeypatch.setattr(V, "write", write)
        assert B.load_changed(spark, files, path, "yellow")["rows"]
        return write(*args, **how)

    monkeypatch.setattr(V, "write", slower)
    with pytest.raises(V.Conflict):
        B.load_changed(spark, files, path, "yellow")
    assert V.read(spark, path, B.TRIPS).count() == land.yellow.where(F.col("source_month").isin(*MONTHS)).count()


def test_ledger_tells_states_apart(spark, landed, tmp_path):
    land, folder, _ = landed
    plan = L.load_plan(spark, "1998-01-01", "1998-05-31", ["yellow"])
    path = str(tmp_path / "yellow")
    deliver(land, folder, "yellow", "1998-04")
    B.load_changed(spark, L.planned_fingerprints(spark, plan, folder), path, "yellow")
    version = V.latest(spark, path)
    # January loses its files, February holds other rows than were loaded, March is delivered again
    V.T.remove(spark, V.folder(path, B.month_key("yellow", "1998-01"), version.parts[B.month_key("yellow", "1998-01")]))
    february = V.folder(path, B.month_key("yellow", "1998-02"), version.parts[B.month_key("yellow", "1998-02")])
    other = spark.read.parquet(february).withColumn("total_amount", F.col("total_amount") + 1).cache()
    n = other.count()
    other.write.mode("overwrite").parquet(february)
    deliver(land, folder, "yellow", "1998-03", land.yellow.where("PULocationID % 2 = 0"))
    landed_now = spark.createDataFrame(L.planned_fingerprints(spark, plan, folder),
                                       "service_type string, source_month string, path string, fingerprint string")
    got = B.load_coverage(plan, B.ledger(spark, [path]), B.reconciled(spark, [path]), landed_now).collect()
    assert {r.year_month: r.status for r in got} == {
        "1998-01": "partial", "1998-02": "partial", "1998-03": "stale", "1998-04": "loaded", "1998-05": "missing"}
    assert {r.year_month: r.rows_loaded for r in got}["1998-02"] == n


def test_small_files_become_few(spark, tmp_path):
    fct, root = layers(spark, SF).star.fct, str(tmp_path / "fct")
    parts = V.write(fct.repartition(5, "trip_key"), root, "fct_trips", partition_by=("pickup_month",))
    V.commit(spark, root, V.Version(), parts, info=V.schema_info(fct_trips=fct.schema))
    held = V.read(spark, root, "fct_trips")
    before = {k: p["files"] for k, p in parts.items()}
    assert max(before.values()) > 1
    put = V.compact(spark, root, "fct_trips", ["pickup_month"])
    after = {k: p["files"] for k, p in V.latest(spark, root).parts.items()}
    assert set(after.values()) == {1} and set(put) == {k for k, n in before.items() if n > 1}
    assert rows(held) == rows(V.read(spark, root, "fct_trips")) == rows(fct)
    assert V.compact(spark, root, "fct_trips", ["pickup_month"]) == {}
    # a target smaller than the files splits none of them, but is met by those that are rewritten
    sizes = {k: p["bytes"] for k, p in parts.items()}
    key = max(sizes, key=sizes.get)
    parts = V.write(fct.repartition(20, "trip_key"), root, "fct_trips", partition_by=("pickup_month",))
    V.commit(spark, root, V.latest(spark, root), parts)
    put = V.compact(spark, root, "fct_trips", ["pickup_month"], target_bytes=parts[key]["bytes"] // 2)
    assert 1 < put[key]["files"] <= 3 and rows(V.read(spark, root, "fct_trips")) == rows(fct)
