"""Every registered query against its SQL counterpart on the smallest data."""

import pytest

import __spark_entry__ as driver
from compare import difference, duck
from farestrata.plans import catalog, landed, oracle  # noqa: F401  landed registers queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys() and SQL.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    assert difference(QUERIES[name](spark, FOLDER), database, SQL[name]) is None


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns[0] == "source_period"
