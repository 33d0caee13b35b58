"""Every registered query equals its DuckDB SQL at sf0.01 (row count, column
names, order-insensitive exact value hash), and the flagship runs on sf0.001."""

import pytest

import __spark_entry__ as entry
from gridsense.plans.queries import QUERIES
from tests.conftest import SF001
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, SF001, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"] > 0, r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Sensor", "Day", "Total"]
    assert df.count() > 0
