"""Every registered query against its SQL."""

import oracle
import pytest
from twinledger.suite import ORACLE, QUERIES

import __spark_entry__ as driver


@pytest.fixture(scope="module")
def duck(small):
    con = oracle.connect(small)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= driver.queries().keys() and set(ORACLE) <= driver.oracle_sql().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    assert oracle.differences(QUERIES[name](spark, small), duck, ORACLE[name]) == []
