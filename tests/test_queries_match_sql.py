"""Every query of the library against its SQL on the smallest tables."""

import pytest
from compare import differences, duckdb_tables
from conftest import SF_DIR

import __spark_entry__ as driver

from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    assert differences(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "transaction_id" and not df.isEmpty()
