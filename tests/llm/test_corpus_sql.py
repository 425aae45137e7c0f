"""Corpus queries against their SQL on the smallest tables; each of the others has its own brute-force test."""

import pytest
from demandgrid.llm import queries
from oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    assert compare(spark, duck(SMALL), SMALL, name, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
