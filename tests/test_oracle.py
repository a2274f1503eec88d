"""Every registered query against its DuckDB SQL on the sf0.01 tables (the
driver's correctness gate, run locally)."""

import importlib.util
import os

import pytest

from conftest import SF01
from nestfold.plans import ORACLES, QUERIES
from nestfold.testing import compare, duckdb_conn


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    if name in ORACLES:
        ok, msg = compare(df, con, ORACLES[name])
        assert ok, msg
    else:
        assert df.count() >= 0


def test_entry_module(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert df.columns == mod.entry(spark).columns
    assert set(mod.oracle_sql()) <= set(mod.queries())
