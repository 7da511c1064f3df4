"""Every registered query gives the rows of its SQL."""

import pytest
from check_queries import compare, views

import __spark_entry__ as registered
from trolley import plans

SF_DIR = "/root/testdata/sf0.001"
QUERIES = plans.queries()
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return views(SF_DIR)


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, db, name):
    verdict = compare(QUERIES[name](spark, SF_DIR), db, SQL[name])
    assert verdict.startswith("ok"), verdict
