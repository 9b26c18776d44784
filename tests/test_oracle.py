"""Every SQL-checked query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

SQL = entry.oracle_sql()
FAST = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    assert compare(spark, SF_SMALL, name, entry.queries()[name], SQL[name], con, verbose=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
