"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from trolley.plans import batch_queries, kept_queries, stored_queries, stream_queries
from trolley.plans.registry import Query
from trolley.session import configure

_MODULES = (batch_queries, stored_queries, stream_queries, kept_queries)


def _registered() -> list[Query]:
    return [query for module in _MODULES for query in module.QUERIES.values()]


def _configured(run: Callable[[SparkSession, str], DataFrame]):
    @wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    return call


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.name: _configured(query.run) for query in _registered()}


def oracle_sql() -> dict[str, str]:
    return {query.name: query.sql for query in _registered() if query.sql is not None}
