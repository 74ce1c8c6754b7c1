"""Every registered query against its DuckDB oracle on the sf0.01 tables:
same column names, types and (order-insensitive) values."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")

SQL = entry.oracle_sql()
QUERIES = {k: q for k, q in entry.queries().items() if k in SQL}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    # the library's own operators all have SQL; the optional training-data
    # queries without SQL have brute-force tests of their own
    from quarry.plans.catalog import QUERIES as own
    assert set(own) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    info = compare(spark, SF, key, QUERIES[key], SQL.get(key), con)
    assert info["names"], info
    assert info["types"] == "same", info
    assert info["match"], info


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["s_name", "c_name"]
    assert df.count() > 0
