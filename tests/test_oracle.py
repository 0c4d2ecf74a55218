"""Every registered query against the same query in DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from compare import connect, difference
from conftest import TABLES

import __spark_entry__ as driver
from winback.plans.oracle import oracle_queries
from winback.plans.registry import QUERIES

SLOW = {"model_comparison"}
ROWS_ONLY = {"model_comparison"}


@pytest.fixture(scope="module")
def duck() -> duckdb.DuckDBPyConnection:
    return connect(TABLES)


def test_every_query_but_the_tree_models_has_an_oracle():
    assert QUERIES.keys() - oracle_queries().keys() == ROWS_ONLY
    assert QUERIES.keys() <= driver.queries().keys() and oracle_queries().keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SLOW))
def test_query_matches_the_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, TABLES), duck, oracle_queries()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
