"""Activity messages derived from the ``events`` table.

An event has fewer columns than an activity record, so the remaining fields are computed
from the ones it has. The expressions are plain enough to mean the same in Spark and in the
SQL the results are compared with.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions import record_json, wire_timestamp
from trolley.schemas import ACTIVITY, MESSAGE

TOPIC = "user-activity"

_SECOND = "date_trunc('second', ts)"

# Activity field -> SQL over ``events``. Contact fields differ from event to event.
FIELDS = {
    "address": "concat(user_id, ' High Street', chr(10), 'Box ', event_id)",
    "annual_income": "CAST(20000 + event_id % 130001 AS INT)",
    "bank_account_number": "concat('BBAN', event_id)",
    "category_id": "concat('c', user_id % 25)",
    "city": "concat('City ', user_id % 100)",
    "company_name": "concat('Company ', user_id % 50)",
    "country": "concat('Country ', user_id % 25)",
    "created_at": _SECOND,
    "credit_card_expiry": "'01/30'",
    "credit_card_number": "concat('4000', event_id)",
    "customer_review": "props",
    "customer_status": "CASE user_id % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Inactive' ELSE 'Pending' END",
    "date_of_birth": "CAST(DATE '1930-01-01' + CAST(user_id * 211 % 30000 AS INT) AS TIMESTAMP)",
    "email": "concat('u', user_id, '.', event_id, '@example.com')",
    "feedback": "concat('Said \"', event_type, '\" about ', props)",
    "first_name": "concat('First', user_id)",
    "gender": (
        "CASE user_id % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Non-binary' "
        "ELSE 'Prefer not to say' END"
    ),
    "job_title": "concat('Job ', user_id % 40)",
    "last_login": _SECOND,
    "last_name": "concat('Last', user_id)",
    "latitude": "concat('47.', event_id)",
    "longitude": "concat('-8.', event_id)",
    "nationality": "concat('Country ', user_id % 30)",
    "payment_method": (
        "CASE event_id % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card' WHEN 2 THEN 'PayPal' "
        "ELSE 'Bank Transfer' END"
    ),
    "phone_number": "concat('+1-555-', event_id)",
    "product_id": "CAST(event_id % 25000 AS VARCHAR(20))",
    "session_duration": "CAST(1 + event_id % 2000 AS INT)",
    "start_date": "CAST(DATE '2020-01-01' + CAST(user_id % 1500 AS INT) AS TIMESTAMP)",
    "subscription_type": "CASE user_id % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Premium' ELSE 'Enterprise' END",
    "timestamp": _SECOND,
    "transaction_amount": "value",
    "transaction_date": _SECOND,
    "twitter_handle": "concat('@u', user_id)",
    "updated_at": _SECOND,
    "user_id": "CAST(user_id AS VARCHAR(20))",
    "user_rating": "CAST(10 + event_id % 41 AS DOUBLE) / 10",
    "username": "concat('user', user_id)",
    "website_url": "concat('https://example.com/', user_id)",
}

# Messages are some 60 times as wide as the events they are made of, so that a split of the table is
# too much for a task that sorts messages; it takes about so many.
PIECE_ROWS = 100_000

# The messages are received two seconds after the event.
_RECEIVED = "ts + INTERVAL '2' SECOND"


def field_sql(*names: str) -> str:
    """``expression AS name`` for a SQL select list."""
    return ", ".join(f'{FIELDS[name]} AS "{name}"' for name in names or ACTIVITY.fieldNames())


def activity_sql(*names: str) -> str:
    """SQL of the records behind ``messages``, with their offset and time of receipt."""
    return f"SELECT {field_sql(*names)}, event_id, {_RECEIVED} AS received FROM events"


def id_sql(kind: str) -> str:
    """SQL of the record id of an event's message."""
    return f"md5(concat('{TOPIC}|', event_id % 3, '|', event_id, '|{kind}'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def envelope(events: DataFrame, value) -> DataFrame:
    """Kafka-shaped rows; the event id serves as offset."""
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr(_RECEIVED).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*MESSAGE.fieldNames())


def spread(df: DataFrame, pieces: int) -> DataFrame:
    """``df`` over at least ``pieces`` partitions, so that a single small file keeps all cores
    busy. Input that is split well enough already is not shuffled."""
    return df if df.rdd.getNumPartitions() >= pieces else df.repartition(pieces)


def events_of(spark: SparkSession, sf_dir: str, waves: int = 1, *, bounded: bool = False) -> DataFrame:
    """The events, split for at least ``waves`` tasks per core; if ``bounded``, also for about
    ``PIECE_ROWS`` per task at most.

    Bounded pieces are ranges of ids, so that what a user does within a while stays in one task.
    """
    events = table(spark, sf_dir, "events")
    pieces = waves * spark.sparkContext.defaultParallelism
    if bounded:
        needed = -(-events.count() // PIECE_ROWS)
        if needed > max(pieces, events.rdd.getNumPartitions()):
            return events.repartitionByRange(needed, "event_id")
    return spread(events, pieces)


def messages(
    spark: SparkSession,
    sf_dir: str,
    *names: str,
    waves: int = 1,
    fields: Mapping[str, str] = FIELDS,
    where: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """One message per event (or per event that meets ``where``), with all activity fields or
    those named; ``bounded`` for queries that sort messages (see ``events_of``)."""
    columns = []
    for name in names or ACTIVITY.fieldNames():
        field = F.expr(fields[name])
        if ACTIVITY[name].dataType.typeName() == "timestamp":
            field = wire_timestamp(field)
        columns.append(field.alias(name))
    events = events_of(spark, sf_dir, waves, bounded=bounded)
    return envelope(events if where is None else events.where(where), record_json(*columns))


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the compared SQL has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else f.name
            for f in df.schema
        ]
    )
