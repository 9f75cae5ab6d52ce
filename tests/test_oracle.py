"""Every registered query against its SQL, over whole tables."""

import importlib

import pytest
from compare import connect, duck_rows, spark_rows

from checks import oracle, queries as checked
from conftest import plan

contract = importlib.import_module("__spark_entry__")
QUERIES = checked.registered()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck(folder):
    with connect(folder) as db:
        yield db


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).columns == [
        "customer_id", "name", "total_revenue", "total_orders"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    assert "CartesianProduct" not in plan(df) and "NestedLoopJoin" not in plan(df)
    found, expected = spark_rows(df), duck_rows(duck, SQL[name])
    assert found[0] == expected[0]
    assert len(found[1]) > 0
    assert found[1] == expected[1]
