"""Streaming jobs, drained to the end of their input and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators import accepted, decode, distinct_rows
from trolley.plans.batch_queries import (
    _FEEDBACK_COLUMNS,
    _INTERACTION_COLUMNS,
    _damaged,
    _facts_sql,
    _FIRST_USERS,
    _STORED,
    stored_users,
)
from trolley.plans.inputs import FIELDS, field_sql, id_sql, messages, table, zoneless
from trolley.plans.registry import Registry
from trolley.schemas import ACTIVITY, FEEDBACK, INTERACTIONS, METRICS, QUARANTINE, USERS, narrowed
from trolley.session import scratch_dir, state_partitions
from trolley.sinks import BatchFolders, ParquetTable
from trolley.sources import message_files
from trolley.streaming import (
    Targets,
    await_query,
    backfill,
    land_json,
    land_parquet,
    land_rejects,
    start_all,
    start_curation,
    start_facts,
    start_users,
)

QUERIES = Registry()

_DRAIN = {"availableNow": True}


def _archive(spark: SparkSession, root: str, make, *arguments: str) -> DataFrame:
    """A stream over messages that are first written below ``root``.

    There are at least two files per core and a batch takes one per core.
    """
    path = f"{root}/messages"
    make(spark, *arguments, waves=2).write.option("compression", "zstd").parquet(path)
    return message_files(spark, path, max_files=spark.sparkContext.defaultParallelism)


# --- landing --------------------------------------------------------------------------------


@QUERIES.add(f"SELECT {field_sql()} FROM events")
def landing_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of every message as Parquet."""
    root = scratch_dir(spark, "landing_parquet")
    stream = _archive(spark, root, messages, sf_dir)
    await_query(land_parquet(stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN))
    return zoneless(spark.read.schema(ACTIVITY).parquet(f"{root}/out"))


@QUERIES.add(f"SELECT {field_sql()} FROM events")
def landing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of every message as JSON lines."""
    root = scratch_dir(spark, "landing_json")
    stream = _archive(spark, root, messages, sf_dir)
    query = land_json(
        stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN, keep="fields", compression="gzip"
    )
    await_query(query)
    return zoneless(spark.read.schema(ACTIVITY).json(f"{root}/out"))


@QUERIES.add(
    """
SELECT concat('{"user_id":"', user_id, '","session_duration":', event_id % 1800, '}') AS "value"
FROM events WHERE event_type NOT IN ('click', 'signup', 'error')
UNION ALL
SELECT CASE event_id % 8 WHEN 1 THEN concat(' {"session_duration":', event_id % 1800, '}')
                         WHEN 4 THEN '5' WHEN 5 THEN 'null' WHEN 6 THEN '[{"user_id":"u"}]'
                         ELSE concat('{"session_duration":', event_id % 1800, '}') END
FROM events WHERE event_type = 'error' AND event_id % 8 NOT IN (2, 3, 7)"""
)
def landing_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever is JSON lands as it was sent, with or without a key."""
    root = scratch_dir(spark, "landing_payload")
    stream = _archive(spark, root, _damaged, sf_dir)
    await_query(land_json(stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN))
    return spark.read.text(f"{root}/out")


@QUERIES.add(
    """
SELECT CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id,
       CAST(event_id % 1800 AS INTEGER) AS session_duration
FROM events WHERE event_type NOT IN ('click', 'signup', 'error')
    OR event_type = 'error' AND event_id % 8 IN (0, 1, 7)"""
)
def landing_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every JSON object lands with its fields, with or without a key; nothing else does."""
    root = scratch_dir(spark, "landing_damaged")
    stream = _archive(spark, root, _damaged, sf_dir)
    await_query(land_parquet(stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN))
    return spark.read.schema(ACTIVITY).parquet(f"{root}/out").select("user_id", "session_duration")


@QUERIES.add(
    """
SELECT event_id AS ingest_offset,
       CASE WHEN event_type = 'signup' THEN 'empty' WHEN event_type = 'click' OR event_id % 8 IN (2, 3)
            THEN 'malformed' ELSE 'no key' END AS reason
FROM events WHERE event_type IN ('click', 'signup') OR event_type = 'error' AND event_id % 8 IN (2, 3, 4, 5, 6)"""
)
def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not a JSON object, with the reason."""
    root = scratch_dir(spark, "landing_rejects")
    stream = _archive(spark, root, _damaged, sf_dir)
    await_query(land_rejects(stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN))
    landed = spark.read.schema(QUARANTINE).parquet(f"{root}/out")
    return landed.select("ingest_offset", "reason")


@QUERIES.add(
    """
SELECT event_id AS ingest_offset, CASE event_type WHEN 'signup' THEN 'empty' ELSE 'malformed' END AS reason
FROM events WHERE event_type IN ('click', 'signup') OR event_type = 'error' AND event_id % 8 IN (2, 3, 7)"""
)
def landing_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not JSON at all."""
    root = scratch_dir(spark, "landing_payload_rejects")
    stream = _archive(spark, root, _damaged, sf_dir)
    query = land_rejects(
        stream, f"{root}/out", f"{root}/checkpoint", trigger=_DRAIN, keep="payload"
    )
    await_query(query)
    landed = spark.read.schema(QUARANTINE).parquet(f"{root}/out")
    return landed.select("ingest_offset", "reason")


# --- curation -------------------------------------------------------------------------------

_NEW_USERS = f"""
SELECT * FROM ({_FIRST_USERS}) AS f
WHERE NOT EXISTS (SELECT 1 FROM ({_STORED}) AS s WHERE s.user_id = f.user_id)"""


def _archive_in_order(spark: SparkSession, root: str, sf_dir: str, parts: int = 4) -> DataFrame:
    """A stream over messages written in the order they arrive, a span of time after the other."""
    path = f"{root}/messages"
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    cuts = [low + (high - low) * i / parts for i in range(1, parts)]
    bounds = [f"TIMESTAMP_NTZ '{cut:%Y-%m-%d %H:%M:%S.%f}'" for cut in cuts]
    for lower, upper in zip([None, *bounds], [*bounds, None]):
        span = [f"ts >= {lower}"] * bool(lower) + [f"ts < {upper}"] * bool(upper)
        messages(spark, sf_dir, where=" AND ".join(span)).write.mode("append").parquet(path)
    return message_files(spark, path, max_files=spark.sparkContext.defaultParallelism)


def _stream_users(spark: SparkSession, sf_dir: str, label: str, **options) -> DataFrame:
    root = scratch_dir(spark, label)
    users = ParquetTable(f"{root}/users", USERS)
    known = stored_users(spark, sf_dir)
    users.create(spark)
    users.write(known.select(*_as_users(known)))
    stream = _archive_in_order(spark, root, sf_dir)
    await_query(start_users(stream, users, f"{root}/checkpoint", trigger=_DRAIN, **options))
    # Users stored before the stream have no name.
    added = users.read(spark).where(F.col("first_name").isNotNull())
    return zoneless(added)


def _as_users(known: DataFrame) -> list:
    return [
        F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in USERS
    ]


@QUERIES.add(_NEW_USERS)
def stream_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users added by a stream to a table that already holds some."""
    return _stream_users(spark, sf_dir, "stream_users")


@QUERIES.add(_NEW_USERS)
def stream_users_remembered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with users of the last hour dropped by the query's own state."""
    return _stream_users(spark, sf_dir, "stream_users_remembered", remember_users="1 hour")


@QUERIES.add("SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, "
             f"{field_sql('subscription_type')} FROM events")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact streaming distinct, kept for the life of the query."""
    root = scratch_dir(spark, "stream_distinct")
    stream = _archive(spark, root, messages, sf_dir, "user_id", "subscription_type")
    records = accepted(decode(stream, narrowed("subscription_type")))
    rows = distinct_rows(records.select("user_id", "subscription_type"))
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    with state_partitions(spark):
        query = writer.option("path", f"{root}/out").trigger(**_DRAIN).start()
    await_query(query)
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@QUERIES.add(
    f"""
SELECT interaction_id AS id, user_id, product_id, category_id, session_duration, NULL AS feedback,
       CAST(NULL AS DOUBLE) AS rating, interaction_date AS "date"
FROM ({_facts_sql("interaction", _INTERACTION_COLUMNS, '"timestamp"', "interaction_date")}) AS i
UNION ALL
SELECT feedback_id, user_id, product_id, NULL, NULL, feedback, rating, feedback_date
FROM ({_facts_sql("feedback", _FEEDBACK_COLUMNS, '"timestamp"', "feedback_date")}) AS f"""
)
def stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fact tables by day received, from one job."""
    root = scratch_dir(spark, "stream_facts")
    facts = ParquetTable(f"{root}/interactions", INTERACTIONS, by_day=True, rebalance=True)
    said = ParquetTable(f"{root}/feedback", FEEDBACK, by_day=True, rebalance=True)
    stream = _archive(spark, root, messages, sf_dir)
    await_query(start_facts(stream, facts, said, f"{root}/checkpoint", trigger=_DRAIN))
    done = facts.read(spark).select(
        F.col("interaction_id").alias("id"), "user_id", "product_id", "category_id", "session_duration",
        F.col("interaction_date").alias("date"),
    )
    heard = said.read(spark).select(
        F.col("feedback_id").alias("id"), "user_id", "product_id", "feedback", "rating",
        F.col("feedback_date").alias("date"),
    )
    return zoneless(done.unionByName(heard, allowMissingColumns=True))


@QUERIES.add(_facts_sql("interaction", _INTERACTION_COLUMNS, '"timestamp"', "interaction_date"))
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic is read twice, the second time without a checkpoint of the first."""
    root = scratch_dir(spark, "stream_replay")
    facts = ParquetTable(f"{root}/interactions", INTERACTIONS, by_day=True, rebalance=True)
    stream = _archive(spark, root, messages, sf_dir)
    for run in ("first", "second"):
        await_query(start_facts(stream, facts, None, f"{root}/{run}", trigger=_DRAIN))
    return zoneless(facts.read(spark).select(*INTERACTIONS.fieldNames()))


@QUERIES.add(
    """
SELECT 'quarantine' AS table_name, count(*) AS n_rows FROM events
WHERE event_type IN ('click', 'signup', 'error')
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM events
WHERE event_type NOT IN ('click', 'signup', 'error')
UNION ALL SELECT 'user_product_interactions', count(*) FROM events
WHERE event_type NOT IN ('click', 'signup', 'error')
UNION ALL SELECT 'user_feedback', count(*) FROM events
WHERE event_type NOT IN ('click', 'signup', 'error')"""
)
def stream_fanout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table as counted by the batches of the combined job."""
    root = scratch_dir(spark, "stream_fanout_metrics")
    metrics = BatchFolders(f"{root}/metrics", METRICS)
    stream = _archive(spark, root, _damaged, sf_dir)
    query = start_all(
        stream,
        ParquetTable(f"{root}/users", USERS),
        BatchFolders(f"{root}/interactions", INTERACTIONS),
        BatchFolders(f"{root}/feedback", FEEDBACK),
        f"{root}/checkpoint",
        quarantine=BatchFolders(f"{root}/quarantine", QUARANTINE),
        metrics=metrics,
        trigger=_DRAIN,
    )
    await_query(query)
    return metrics.read(spark).groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))


@QUERIES.add(
    f"""
SELECT DISTINCT 'users' AS table_name, CAST(user_id AS VARCHAR) AS key, NULL AS product_id FROM events
UNION ALL SELECT 'user_product_interactions', {id_sql("interaction")}, {FIELDS["product_id"]} FROM events
UNION ALL SELECT 'user_feedback', {id_sql("feedback")}, {FIELDS["product_id"]} FROM events"""
)
def stream_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined job with every batch staged as a table instead of in memory."""
    root = scratch_dir(spark, "stream_staged")
    tables = {
        "users": ParquetTable(f"{root}/users", USERS),
        "user_product_interactions": ParquetTable(f"{root}/interactions", INTERACTIONS, by_day=True),
        "user_feedback": ParquetTable(f"{root}/feedback", FEEDBACK, by_day=True),
    }
    keys = {"users": "user_id", "user_product_interactions": "interaction_id", "user_feedback": "feedback_id"}
    stream = _archive(spark, root, messages, sf_dir)
    query = start_curation(
        stream,
        Targets(*tables.values()),
        f"{root}/checkpoint",
        trigger=_DRAIN,
        staging=f"{root}/staging",
    )
    await_query(query)
    contents = [
        stored.read(spark).select(
            F.lit(name).alias("table_name"),
            F.col(keys[name]).alias("key"),
            (F.lit(None).cast("string") if name == "users" else F.col("product_id")).alias("product_id"),
        )
        for name, stored in tables.items()
    ]
    return reduce(DataFrame.unionByName, contents)


@QUERIES.add(
    """
SELECT CAST(0 AS BIGINT) AS batch_id, 'users' AS table_name, count(DISTINCT user_id) AS n_rows FROM events
UNION ALL SELECT 0, 'user_product_interactions', count(*) FROM events
UNION ALL SELECT 0, 'user_feedback', count(*) FROM events
UNION ALL SELECT 1, 'users', 0
UNION ALL SELECT 1, 'user_product_interactions', 0
UNION ALL SELECT 1, 'user_feedback', 0"""
)
def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added by reading the bounded messages once, and again."""
    root = scratch_dir(spark, "backfill_counts")
    targets = Targets(
        ParquetTable(f"{root}/users", USERS),
        ParquetTable(f"{root}/interactions", INTERACTIONS, by_day=True),
        ParquetTable(f"{root}/feedback", FEEDBACK, by_day=True),
        metrics=BatchFolders(f"{root}/metrics", METRICS),
    )
    sent = messages(spark, sf_dir)
    for batch_id in range(2):
        backfill(sent, targets, batch_id=batch_id)
    return targets.metrics.read(spark).select(*METRICS.fieldNames())
