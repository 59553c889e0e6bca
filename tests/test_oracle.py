"""Every registered query against its DuckDB SQL on the smallest shared
tables (the driver runs the same check at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, duck  # noqa: E402
from runlens.plans.oracle_sql import ORACLE  # noqa: E402
from runlens.plans.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("shared tables not present")
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "job_elapsed_time_sec" in df.columns
