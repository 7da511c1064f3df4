"""Queries over the test tables, each with the SQL it is checked against."""

from trolley.plans.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
