"""Queries that SQL expresses, against their DuckDB twins."""

import pytest
from conftest_llm import SF01
from oracle_check import compare, duck_connect

import __spark_entry__ as E
from shelfline.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck_connect(SF01), name, E.queries()[name], registry.ORACLES[name], SF01)
    assert r["status"] == "ok", r
    assert r["spark_rows"] > 0


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.QUERIES) | {"pipeline"} <= names
