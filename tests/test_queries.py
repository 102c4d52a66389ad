"""Every registered query with SQL gives what DuckDB gives."""

import pytest

import __spark_entry__ as driver
from ferrywright.plans import oracle as plans_oracle
from ferrywright.plans import queries as plans_queries
from tests.compare import oracle_connection, rows_of

QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return oracle_connection(sf)


def test_every_query_has_sql():
    assert set(plans_oracle.ORACLE) == set(plans_queries.QUERIES)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    row = driver.entry(spark).first()
    assert row.copy + row.skip + row.fail == 200
