"""Registered queries against the same question in SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from stellate.queries.registry import ORACLES, QUERIES
from oracle import connect, differences

# Single star tables are covered by ``star_load`` here and run one by one by the driver.
STAR_TABLES = {
    n for n in QUERIES if n.startswith(("dim_", "fact_", "bridge_")) and n != "dim_date"
}
NAMES = [n for n in QUERIES if n not in STAR_TABLES]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(name, spark, sf_dir, connection):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, connection, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["dim_phase", "dim_distinct", "bridge_delimited"])
def test_star_table_equals_sql(name, spark, sf_dir, connection):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, connection, contract.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
