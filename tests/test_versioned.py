"""Parts replaced while others read: versions, conflicts, delayed removal."""

import threading

import pytest
from pyspark.sql import functions as F

from tripmart.operators import gold as G
from tripmart.plans.catalog import layers
from tripmart.sources import tables as T
from tripmart.sources import versioned as V

SF = "/root/testdata/sf0.001"


def months(spark, rows):
    return spark.createDataFrame(rows, "id long, month string")


def put(spark, root, rows, base=None, **how):
    base = V.latest(spark, root) if base is None else base
    df = months(spark, rows)
    return V.commit(spark, root, base, V.write(df, root, "t", partition_by=("month",)),
                    info=None if base.number else V.schema_info(t=df.schema), **how)


def seen(df):
    return sorted(tuple(r) for r in df.collect())


def test_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path / "v")
    first = put(spark, root, [(1, "a"), (2, "b")])
    held = V.read(spark, root, "t")
    put(spark, root, [(3, "b"), (4, "c")])
    V.vacuum(spark, root)  # replaced a moment ago: stays
    assert seen(held) == [(1, "a"), (2, "b")] == seen(V.read(spark, root, "t", first))
    assert seen(V.read(spark, root, "t")) == [(1, "a"), (3, "b"), (4, "c")]
    assert seen(V.read(spark, root, "t", keys=["t/month=b"])) == [(3, "b")]
    removed = V.vacuum(spark, root, hours=0)
    assert [p.rsplit("/", 1)[1] for p in removed] == ["month=b"]
    assert seen(V.read(spark, root, "t")) == [(1, "a"), (3, "b"), (4, "c")]
    with pytest.raises(Exception, match="exist"):
        held.collect()


def test_a_read_runs_while_a_replace_commits(spark, tmp_path):
    root = str(tmp_path / "v")
    put(spark, root, [(i, "a") for i in range(50)])
    slow = F.udf(lambda x: __import__("time").sleep(0.02) or x, "long")
    held, got = V.read(spark, root, "t").repartition(2).select(slow("id").alias("id")), []
    reader = threading.Thread(target=lambda: got.extend(r[0] for r in held.collect()))
    reader.start()
    put(spark, root, [(99, "a")])
    V.vacuum(spark, root)
    reader.join()
    assert sorted(got) == list(range(50)) and seen(V.read(spark, root, "t")) == [(99, "a")]


def test_two_writers(spark, tmp_path):
    root = str(tmp_path / "v")
    base = put(spark, root, [(1, "a"), (2, "b")])
    put(spark, root, [(3, "b")], base)
    put(spark, root, [(4, "c")], base)           # other parts: put on top
    assert seen(V.read(spark, root, "t")) == [(1, "a"), (3, "b"), (4, "c")]
    with pytest.raises(V.Conflict, match="month=b"):
        put(spark, root, [(5, "b"), (6, "d")], base)
    with pytest.raises(V.Conflict):
        put(spark, root, [(7, "z")], base, whole=True)
    assert seen(V.read(spark, root, "t")) == [(1, "a"), (3, "b"), (4, "c")]
    runs = {p.name for p in (tmp_path / "v" / "data" / "t").iterdir() if not p.name.startswith(".")}
    assert len(runs) == 3                        # the losers' files are gone


def test_numbers_are_taken_once(spark, tmp_path, monkeypatch):
    """Two writers that both saw the same head: the second looks again."""
    root = str(tmp_path / "v")
    base = put(spark, root, [(1, "a")])
    assert not V._publish(spark, root, V.Version(base.number, 0.0))
    real, calls = V.latest, []

    def stale(spark, root):
        calls.append(1)
        return base if len(calls) == 2 else real(spark, root)

    put(spark, root, [(2, "b")])
    monkeypatch.setattr(V, "latest", stale)
    mine = V.commit(spark, root, real(spark, root), V.write(months(spark, [(3, "c")]), root, "t", partition_by=("month",)))
    assert mine.number == 3


def test_what_a_failed_writer_left_goes(spark, tmp_path):
    root = str(tmp_path / "v")
    put(spark, root, [(1, "a")])
    left = V.write(months(spark, [(2, "a")]), root, "t", partition_by=("month",))
    assert V.vacuum(spark, root) == []           # it may still be writing
    assert V.vacuum(spark, root, hours=0) == [V.run_folder(root, "t", next(iter(left.values())))]
    assert seen(V.read(spark, root, "t")) == [(1, "a")]


def test_part_statistics_and_empty_parts(spark, tmp_path):
    root = str(tmp_path / "v")
    df = months(spark, [(1, "a"), (2, "a"), (5, None)])
    parts = V.write(df, root, "t", partition_by=("month",), measures={"most": F.max("id")})
    assert {k: (p["rows"], p["most"], p["of"]) for k, p in parts.items()} == {
        "t/month=a": (2, 2, 2), "t/month=__HIVE_DEFAULT_PARTITION__": (1, 5, 2)}
    assert all(p["files"] >= 1 and p["bytes"] > 0 for p in parts.values())
    V.commit(spark, root, V.Version(), parts, info=V.schema_info(t=df.schema))
    assert sorted(seen(V.read(spark, root, "t")), key=str) == [(1, "a"), (2, "a"), (5, None)]
    assert V.write(df.limit(0), root, "t", partition_by=("month",)) == {}
    whole = V.write(df.limit(0), root, "u")
    assert whole["u"]["rows"] == 0
    V.commit(spark, root, V.latest(spark, root), whole, info=V.schema_info(u=df.schema))
    assert V.read(spark, root, "u").columns == ["id", "month"] and V.read(spark, root, "u").count() == 0
    gone = V.commit(spark, root, V.latest(spark, root), {}, drop=["t/month=a"])
    assert seen(V.read(spark, root, "t", gone)) == [(5, None)]
    with pytest.raises(FileNotFoundError):
        V.read(spark, root, "unknown")


def test_star_readers_and_writers(spark, tmp_path):
    star = layers(spark, SF).star
    path = str(tmp_path / "gold")
    first = G.write_star(spark, star, path, rebalance=True)
    n = first.fct.count()
    small = G.Star(star.fct.where(F.col("pu_zone_key") % 2 == 0), star.dim_date, star.dim_zone, star.dim_service_type,
                   star.dim_payment_type, star.dim_vendor, star.settings)
    base = V.latest(spark, path)
    second = G.write_star(spark, small, path, rebalance=True)
    assert first.fct.count() == n > second.fct.count() == V.latest(spark, path).rows("fct_trips")
    late = G.write_dimensions(star, path)
    with pytest.raises(V.Conflict):
        V.commit(spark, path, base, late, whole=True)
    assert T.table_exists(spark, path) and G.read_star(spark, path, star.settings, base).fct.count() == n


def test_compaction_query_deals_the_fact_to_more_tasks_as_it_grows(spark, monkeypatch):
    """Beyond SMALL_FILE_TRIPS trips a task: the rows that one task takes stay bounded."""
    from tripmart.plans import catalog

    written = []

    def write(df, *args, write=V.write, **how):
        written.append(write(df, *args, **how))
        return written[-1]

    monkeypatch.setattr(V, "write", write)
    monkeypatch.setattr(catalog, "SMALL_FILE_TRIPS", 500)
    rows = catalog.fact_compaction(spark, "/root/testdata/sf0.001").collect()
    assert max(p["files"] for p in written[0].values()) > 6
    assert {r["files"] for r in rows} == {1} and sum(r["trips"] for r in rows) == sum(p["rows"] for p in written[0].values())


def test_partitions_of_files_are_cut_without_a_pattern(spark, tmp_path):
    """Of several levels, with nulls, and of a table without partitions."""
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "a", "x")], "id int, p string, q string")
    parts = V.write(df, str(tmp_path), "t", partition_by=("p", "q"))
    assert {k: p["rows"] for k, p in parts.items()} == {"t/p=a/q=x": 2, "t/p=__HIVE_DEFAULT_PARTITION__/q=y": 1}
    assert V.write(df, str(tmp_path), "u")["u"]["rows"] == 3
    assert "regexp" not in str(V._partition(2))
