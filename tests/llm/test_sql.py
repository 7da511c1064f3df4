"""Queries that SQL can express give its rows."""

import pytest
from check_queries import compare, views

from trolley.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, name):
    verdict = compare(queries.QUERIES[name](spark, SF_DIR), views(SF_DIR), queries.SQL[name])
    assert verdict.startswith("ok"), verdict


def test_all_operators_have_a_query():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
