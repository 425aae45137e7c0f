"""Every query of the analytics engine against its SQL on the smallest tables; those without SQL must give rows."""

import pytest

import __spark_entry__ as driver
from oracle_check import compare, duck

from conftest import SMALL

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("op") and n != "pipeline"])
def test_query(spark, con, name):
    assert compare(spark, con, SMALL, name, QUERIES[name], SQL.get(name)) == ""


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 10
