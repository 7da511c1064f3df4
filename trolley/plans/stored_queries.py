"""Queries that go through JDBC or a stored table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import accepted, decode, interactions, missing_references, new_rows
from trolley.plans.batch_queries import (
    _DISTINCT_NEW,
    _FIRST_USERS,
    _INTERACTION_COLUMNS,
    _facts_sql,
    stored_users,
    users_distinct,
    users_first_seen,
)
from trolley.plans.inputs import messages, table, zoneless
from trolley.plans.registry import Registry
from trolley.schemas import FACTS_PAYLOAD, INTERACTIONS, USERS
from trolley.session import in_one_process, scratch_dir
from trolley.sinks import JdbcTable, LedgerTable, ParquetTable, Table, write_bucketed
from trolley.sources import Jdbc, column_bounds, even_starts, key_ranges, read_query, read_table

QUERIES = Registry()

# Names the database of the JDBC queries. In-memory Derby, the default, only exists inside one
# process, so it is used by sessions of one process alone.
URL_SETTING = "spark.trolley.jdbc.url"


def _database(spark: SparkSession) -> Jdbc:
    url = spark.conf.get(URL_SETTING, None)
    if url is None:
        if not in_one_process(spark):
            raise ValueError(f"set {URL_SETTING} to a database all executors can reach")
        url = f"jdbc:derby:memory:trolley{uuid.uuid4().hex};create=true"
    return Jdbc(url)


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:8]}"


_EVENT_TYPES = "user_id varchar(64), event_type varchar(64), props varchar(256)"
_EVENTS_SQL = (
    "SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, value, props FROM events"
)


def _stored_events(spark: SparkSession, sf_dir: str) -> tuple[Jdbc, str]:
    db, name = _database(spark), _name("events")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    JdbcTable(db, name, events.schema, column_types=_EVENT_TYPES).write(events)
    return db, name


@QUERIES.add(_EVENTS_SQL)
def jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append to a database table and read it back over four connections."""
    db, name = _stored_events(spark, sf_dir)
    lo, hi = column_bounds(spark, db, name, "event_id")
    return zoneless(read_table(spark, db, name, partition=("event_id", lo, hi, 4)))


@QUERIES.add("SELECT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events")
def jdbc_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a table split by ranges of its string key."""
    db, name = _stored_events(spark, sf_dir)
    ranges = key_ranges(db, "user_id", ["2", "4", "6", "8"])
    return read_table(spark, db, name, ["user_id", "event_type"], predicates=ranges)


@QUERIES.add("SELECT c_custkey AS user_id, c_name AS first_name FROM customer")
def jdbc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection that the database computes."""
    db, name = _database(spark), _name("users")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("first_name"), "c_acctbal"
    )
    JdbcTable(db, name, rows.schema, column_types="first_name varchar(64)").write(rows)
    lo, hi = column_bounds(spark, db, name, "user_id")
    query = f"SELECT {db.quote('user_id')}, {db.quote('first_name')} FROM {name}"
    return read_query(spark, db, query, partition=("user_id", lo, hi, 4))


@QUERIES.add(
    """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem AS l
WHERE NOT EXISTS (SELECT 1 FROM part AS p WHERE p.p_partkey = l.l_partkey AND p.p_size < 40)"""
)
def jdbc_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items checked against a dimension that a database selects."""
    db, name = _database(spark), _name("parts")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    JdbcTable(db, name, parts.schema).write(parts)
    lo, hi = column_bounds(spark, db, name, "p_partkey")
    key, size = db.quote("p_partkey"), db.quote("p_size")
    query = f"SELECT {key} AS {db.quote('l_partkey')} FROM {name} WHERE {size} < 40"
    known = read_query(spark, db, query, partition=("l_partkey", lo, hi, 4))
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return missing_references(facts, known, "l_partkey")


_USER_TYPES = ", ".join(
    f"{field.name} varchar(255)" for field in USERS if field.dataType.typeName() == "string"
)


def _added_twice(spark: SparkSession, sf_dir: str, users: Table) -> DataFrame:
    users.create(spark)
    for batch_id in range(2):
        rows = users_first_seen(spark, sf_dir)
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in USERS])
        users.write(new_rows(rows, users.stored(spark, "user_id", None), "user_id"), batch_id)
    return zoneless(users.read(spark))


@QUERIES.add(_FIRST_USERS)
def jdbc_new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users go into a database table twice; the second time none is new."""
    users = JdbcTable(_database(spark), _name("users"), USERS, column_types=_USER_TYPES)
    return _added_twice(spark, sf_dir, users)


@QUERIES.add(_facts_sql("interaction", _INTERACTION_COLUMNS, '"timestamp"', "interaction_date"))
def jdbc_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions in batches, each of which is written twice; no stored id is looked up."""
    db, name = _database(spark), _name("interactions")
    types = ", ".join(f"{f.name} varchar(64)" for f in INTERACTIONS if f.dataType.typeName() == "string")
    # A lasting database keeps the ledger, so each run's new table goes by a name of its own there.
    facts = LedgerTable(JdbcTable(db, name, INTERACTIONS, column_types=types), name, "interaction_id")
    facts.create(spark)
    for batch in (0, 1):
        mine = messages(spark, sf_dir, *FACTS_PAYLOAD.fieldNames(), where=f"event_id % 2 = {batch}")
        rows = interactions(accepted(decode(mine, FACTS_PAYLOAD)))
        for _ in range(2):
            facts.write(rows, batch)
    return zoneless(facts.read(spark))


@QUERIES.add(
    """
SELECT count(*) AS n_rows, true AS even FROM events"""
)
def jdbc_even_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table over ranges of skewed text keys, and whether the largest range has at most
    twice the mean."""
    db, name = _database(spark), _name("skewed")
    skewed = F.expr("concat(CASE WHEN event_id % 10 < 9 THEN 'zürich-' ELSE 'a' END, string(event_id))").alias("key_id")
    keys = table(spark, sf_dir, "events").select(skewed)
    JdbcTable(db, name, keys.schema).write(keys)
    ranges = key_ranges(db, "key_id", even_starts(spark, db, name, "key_id", 8))
    split = read_table(spark, db, name, predicates=ranges)
    sizes = split.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    even = F.max("n") <= 2 * F.sum("n") / len(ranges)
    return sizes.agg(F.sum("n").alias("n_rows"), even.alias("even"))


@QUERIES.add(_FIRST_USERS)
def parquet_new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a folder of Parquet files."""
    return _added_twice(spark, sf_dir, ParquetTable(scratch_dir(spark, "users"), USERS))


@QUERIES.add(_DISTINCT_NEW)
def new_users_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti-join against a table kept hashed by user, which is not shuffled again."""
    name = _name("stored_users")
    path = scratch_dir(spark, name)
    write_bucketed(stored_users(spark, sf_dir), name, "user_id", 8, path=path)
    return new_rows(users_distinct(spark, sf_dir), spark.table(name), "user_id")
