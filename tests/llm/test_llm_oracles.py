"""The queries that SQL can express, and the smoke of the others, on whole small tables."""

import compare
import pytest
from kinomart.llm import oracles, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, con, name):
    assert compare.difference(queries.queries()[name](spark, FOLDER), con, oracles.oracle_sql()[name]) == ""


def test_one_query_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.queries()]
    assert sorted(numbers) == list(range(1, 14))
