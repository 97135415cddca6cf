"""Answers from the rollup equal those from the fact, also after months changed."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators import gold as G
from tripmart.operators import rollup as R
from tripmart.plans.catalog import layers
from tripmart.plans.questions import QUESTIONS
from tripmart.sources import versioned as V

SF = "/root/testdata/sf0.001"


def rows(df, columns):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*columns).collect())


def same_answers(star, rollup):
    star = G.Star(**{**star.__dict__, "settings": star.settings.with_(min_trips=5)})
    for name, answer in R.ANSWERS.items():
        want = QUESTIONS[name](star)
        assert rows(answer(star, rollup), want.columns) == rows(want, want.columns), name


def test_answers_and_refresh_by_month(spark, tmp_path):
    path = str(tmp_path / "gold")
    lazy = layers(spark, SF).star
    star = G.write_star(spark, lazy, path, rebalance=True)
    with pytest.raises((ValueError, FileNotFoundError)):
        R.read_rollup(spark, path)
    first = R.refresh_rollup(spark, path)
    assert first["rows"] == V.latest(spark, path).rows(R.ROLLUP) < star.fct.count()
    assert R.refresh_rollup(spark, path) == {"rows": 0, "months": []}
    same_answers(star, R.read_rollup(spark, path))

    # one month of the fact is replaced, another one goes
    base = V.latest(spark, path)
    months = sorted(k for k in base.of("fct_trips"))
    changed, gone = months[3], months[5]
    month = changed.split("=")[1]
    part = G.write_fact(lazy.fct.where((F.col("pickup_month") == month) & (F.col("pu_zone_key") % 2 == 0)), path)
    V.commit(spark, path, base, part, drop=[gone])
    with pytest.raises(ValueError, match="older"):
        R.read_rollup(spark, path)
    before = {k: p["run"] for k, p in base.of(R.ROLLUP).items()}
    assert R.refresh_rollup(spark, path)["months"] == [month]
    after = {k: p["run"] for k, p in V.latest(spark, path).of(R.ROLLUP).items()}
    assert set(before) - set(after) == {gone.replace("fct_trips", R.ROLLUP)}
    assert {k for k in after if after[k] != before[k]} == {changed.replace("fct_trips", R.ROLLUP)}
    same_answers(G.read_star(spark, path, star.settings), R.read_rollup(spark, path))


def test_a_rewritten_star_needs_its_rollup_again(spark, tmp_path):
    path = str(tmp_path / "gold")
    lazy = layers(spark, SF).star
    G.write_star(spark, lazy, path, rebalance=True)
    R.refresh_rollup(spark, path)
    G.write_star(spark, lazy, path, rebalance=True)
    with pytest.raises(ValueError, match="older"):
        R.read_rollup(spark, path)
    assert R.refresh_rollup(spark, path)["rows"] == R.read_rollup(spark, path).count() > 0


def test_rollup_plan_reads_no_fact(spark, tmp_path):
    path = str(tmp_path / "gold")
    star = G.write_star(spark, layers(spark, SF).star, path, rebalance=True)
    R.refresh_rollup(spark, path)
    answer = R.ANSWERS["q01_trips_by_month"](star, R.read_rollup(spark, path))
    tables = {f.split("/data/")[1].split("/")[0] for f in answer.inputFiles()}
    assert tables == {"trip_rollup", "dim_date"}
    assert "dynamicpruningexpression(pickup_month" in answer._jdf.queryExecution().executedPlan().toString()
