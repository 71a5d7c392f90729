"""Every registered query against its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TRAINING_DATA = ("op", "pipeline")  # tested with their own package, some without SQL
QUERIES = {k: v for k, v in entry.queries().items() if not k.startswith(TRAINING_DATA)}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return compare.oracle(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), con, SQL[name]) == ""


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 55
