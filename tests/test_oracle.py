"""Every registered query against its DuckDB statement on sf0.001."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import duck, value_hash  # noqa: E402

from tripmart.plans.catalog import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    missing = set(KEYS) - set(E.oracle_sql())
    assert not missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "service_type", "total_trips"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert value_hash(df.columns, rows)[0] == value_hash(ocols, orows)[0]
