"""Every registered query against its DuckDB twin (the driver's gate), at
sf0.001 for speed; run tests/oracle_harness.py for sf0.01."""

import math

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck
from churnwise.plans.registry import load_all

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", [n for n, e in REG.items() if e.sql is not None])
def test_query_matches_oracle(spark, con, name):
    e = REG[name]
    r = compare(spark, SF_SMALL, name, e.fn, e.sql, con)
    assert r["status"] == "EXACT", r


@pytest.mark.parametrize("name", [n for n, e in REG.items() if e.sql is None])
def test_rows_only_query_runs(spark, name):
    """Queries without a twin give rows whose numbers are finite; what they compute is tested in test_rows_only.py,
    test_model_parts.py, test_sources.py and test_ml.py."""
    df = REG[name].fn(spark, SF_SMALL)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    assert all(math.isfinite(v) for r in rows for v in r if isinstance(v, float))
