"""Tables and queries over JDBC."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Jdbc:
    """A database: url, driver class, and options such as ``user`` and ``password``."""

    url: str
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def all_options(self) -> dict[str, str]:
        driver = {} if self.driver is None else {"driver": self.driver}
        return {"url": self.url, **driver, **self.options}

    def quote(self, name: str) -> str:
        mark = "`" if self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
        return f"{mark}{name.replace(mark, mark * 2)}{mark}"


def read_table(
    spark: SparkSession,
    db: Jdbc,
    table: str,
    columns: Sequence[str] | None = None,
    *,
    partition: tuple[str, object, object, int] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table, over as many connections as it is split into.

    ``partition`` is ``(column, lower, upper, parts)`` for a numeric, date or timestamp column;
    ``predicates`` are disjoint SQL conditions, one task each (see ``key_ranges``). Without
    either the whole table comes through a single task, which only suits small tables.
    """
    if partition is not None and predicates is not None:
        raise ValueError("give partition or predicates, not both")
    if predicates is not None:
        options = {k: v for k, v in db.all_options().items() if k != "url"}
        df = spark.read.jdbc(db.url, table, predicates=list(predicates), properties=options)
    else:
        reader = spark.read.format("jdbc").options(**db.all_options()).option("dbtable", table)
        if partition is not None:
            column, lower, upper, parts = partition
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        df = reader.load()
    return df if columns is None else df.select(*columns)


def read_query(
    spark: SparkSession,
    db: Jdbc,
    query: str,
    *,
    partition: tuple[str, object, object, int] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """The result of a query that the database runs, split like a table (see ``read_table``).

    Without a split it comes through a single task: for aggregates and other small results.
    """
    return read_table(spark, db, f"({query}) trolley_query", partition=partition, predicates=predicates)


def column_bounds(spark: SparkSession, db: Jdbc, table: str, column: str) -> tuple:
    """Smallest and largest value of a column, computed by the database."""
    name = db.quote(column)
    query = f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}"
    return tuple(read_query(spark, db, query).first())


def key_ranges(db: Jdbc, column: str, starts: Sequence[str] = string.hexdigits[1:16]) -> list[str]:
    """Predicates that split a table by ranges of a string key.

    ``starts`` are the lower ends of all ranges but the first; the default suits keys that
    begin with a hex digit, such as UUIDs. The ranges cover every key, null included.
    """
    name = db.quote(column)
    cuts = sorted(set(starts))
    quoted = ["'" + cut.replace("'", "''") + "'" for cut in cuts]
    if not quoted:
        return ["1 = 1"]
    first = f"({name} < {quoted[0]} OR {name} IS NULL)"
    inner = [f"({name} >= {lo} AND {name} < {hi})" for lo, hi in zip(quoted, quoted[1:])]
    return [first, *inner, f"({name} >= {quoted[-1]})"]


def even_starts(spark: SparkSession, db: Jdbc, table: str, column: str, parts: int = 16) -> list[str]:
    """Keys that cut a table into ``parts`` ranges of as many rows, for ``key_ranges``.

    The database finds them by its own order of the column, whatever alphabet the keys have; with an
    index on it that is a walk along the index. A key that many rows share is one cut, so that fewer
    ranges may come out. Nulls are left out here and are part of the first range.
    """
    name = db.quote(column)
    n = read_query(spark, db, f"SELECT COUNT({name}) AS n FROM {table}").first()[0]
    cuts = {n * i // parts for i in range(1, parts)} - {0}
    found = [read_query(spark, db, _row_at(db, table, name, place)).first() for place in sorted(cuts)]
    return list(dict.fromkeys(row[0] for row in found if row is not None))


def _row_at(db: Jdbc, table: str, name: str, place: int) -> str:
    """The key that has ``place`` keys before it."""
    ordered = f"SELECT {name} AS k FROM {table} WHERE {name} IS NOT NULL ORDER BY {name}"
    if db.url.startswith(("jdbc:mysql:", "jdbc:mariadb:", "jdbc:sqlite:")):
        return f"{ordered} LIMIT 1 OFFSET {place}"
    return f"{ordered} OFFSET {place} ROWS FETCH NEXT 1 ROWS ONLY"
