"""A query next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


class Registry(dict[str, Query]):
    """Queries of a module by name."""

    def add(self, sql: str | None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            self[run.__name__] = Query(run.__name__, run, sql)
            return run

        return register
