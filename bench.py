"""Benchmark: build the star schema from the supplied tables, then time the
20 questions over the written star.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per question, default 3), BENCH_DUCKDB (1 = also time
DuckDB on the same written star, default 1).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the sum over the 20 questions of the median warm time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WITH_DUCKDB = os.environ.get("BENCH_DUCKDB", "1") == "1"


def _sf(sf_dir: str) -> float | str:
    name = Path(sf_dir.rstrip("/")).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def _timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def spark_bench() -> tuple[dict, dict]:
    from tripmart.config import TESTDATA
    from tripmart.operators import gold as G
    from tripmart.plans.catalog import layers
    from tripmart.plans.questions import QUESTIONS
    from tripmart.session import local_session, new_table_path

    spark = local_session(CPUS, shuffle_partitions=max(8, 2 * CPUS), app="tripmart-bench")
    times: dict[str, float] = {}
    path = new_table_path(spark, "bench_star")
    times["jvm_warmup"], _ = _timed(lambda: spark.range(1000).selectExpr("sum(id)").collect())

    def build():
        lazy = layers(spark, SF_DIR, TESTDATA).star
        # The adapter's lineitem is not clustered by month: rebalance the write.
        return G.write_star(spark, lazy, path, rebalance=True)

    times["build_star"], star = _timed(build)
    star.zones()  # size check of dim_zone once, reused by every question
    info = {"star_path": f"{path}/data",
            "fact_rows": star.fct.count(), "jobs": {}, "scans": {}}

    for name, fn in QUESTIONS.items():
        spark.sparkContext.setJobGroup(name, name)
        answer = fn(star)
        answer.collect()  # warm-up
        info["jobs"][name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        info["scans"][name] = answer._jdf.queryExecution().executedPlan().toString() \
            .split("Initial Plan")[0].count("FileScan")
        runs = [_timed(lambda: fn(star).collect())[0] for _ in range(RUNS)]
        times[name] = statistics.median(runs)
    spark.stop()
    return times, info


def duckdb_bench(star_path: str) -> dict:
    import duckdb

    from tripmart.plans.oracle import prefix, questions

    con = duckdb.connect()
    con.execute(f"SET threads = {CPUS}")
    for t in ("lineitem", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    # the counterpart of build_star: the fact and the zones, written by month
    with tempfile.TemporaryDirectory() as folder:
        build, _ = _timed(lambda: [con.execute(
            f"COPY ({prefix()} SELECT *, date_trunc('month', pickup_date) AS pickup_month FROM fct) TO '{folder}/fct' (FORMAT parquet, PARTITION_BY (pickup_month))"
            if name == "fct" else f"COPY ({prefix()} SELECT * FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
            for name in ("fct", "dim_zone")])
    for t in ("lineitem", "supplier", "nation", "region"):
        con.execute(f"DROP VIEW {t}")
    for t in ("dim_date", "dim_zone", "dim_service_type", "dim_payment_type", "dim_vendor"):
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM read_parquet('{star_path}/{t}/*/*.parquet')")
    con.execute(f"CREATE TABLE fct AS SELECT * FROM read_parquet('{star_path}/fct_trips/*/*/*.parquet')")
    con.execute("""CREATE VIEW _minutes AS SELECT f.*,
        CAST(date_diff('microsecond', pickup_ts, dropoff_ts) AS DOUBLE) / 60000000.0 AS minutes,
        CAST(date_diff('microsecond', pickup_ts, dropoff_ts) AS DOUBLE) / 3600000000.0 AS hours
        FROM fct f""")
    out = {"build_star": build}
    for name, sql in questions().items():
        con.execute(sql).fetchall()
        runs = [_timed(lambda: con.execute(sql).fetchall())[0] for _ in range(RUNS)]
        out[name] = statistics.median(runs)
    return out


def main() -> None:
    t0 = time.perf_counter()
    times, info = spark_bench()
    questions_total = sum(v for k, v in times.items() if k.startswith("q"))  # the 20 questions
    result = {
        "metric": "questions_total_sec",
        "value": round(questions_total, 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()},
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
        "fact_rows": info["fact_rows"],
        "jobs": info["jobs"],
        "scans": info["scans"],
    }
    if WITH_DUCKDB:
        try:
            dq = duckdb_bench(info["star_path"])
            result["duckdb_build_star_sec"] = round(dq.pop("build_star"), 4)
            result["duckdb_queries"] = {k: round(v, 4) for k, v in dq.items()}
            result["duckdb_total_sec"] = round(sum(dq.values()), 4)
        except Exception as exc:  # noqa: BLE001 - the second figure is optional
            result["duckdb_error"] = str(exc)[:200]
    result["wall_sec"] = round(time.perf_counter() - t0, 2)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
