"""Every registered query against its DuckDB twin at sf0.01."""

import pytest

from conftest import SF01
from oracle_check import compare, duck_connect

import __spark_entry__ as E
from shelfline import catalog

QUERIES = {name: fn for name, fn in E.queries().items() if name in catalog.QUERIES}
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF01)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Store", "Store_Type", "Store_Size", "total_weeks",
                          "avg_weekly_sales", "total_sales", "avg_temperature",
                          "avg_fuel_price"]
