"""Operators on batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions import record_id, record_json, wire_timestamp
from trolley.operators import (
    accepted,
    activity_rules,
    decode,
    distinct_rows,
    drop_empty,
    drop_replays,
    earliest_per_key,
    feedback,
    interactions,
    missing_reference_counts,
    missing_references,
    new_rows,
    partials,
    rejected,
    rule_violations,
    sample_rows,
    users,
)
from trolley.operators.dedup import ARRIVAL
from trolley.plans.inputs import (
    FIELDS,
    activity_sql,
    envelope,
    events_of,
    field_sql,
    id_sql,
    messages,
    table,
    zoneless,
)
from trolley.plans.registry import Registry
from trolley.schemas import ACTIVITY, FACTS_PAYLOAD, INTERACTIONS, USERS, USERS_PAYLOAD, narrowed
from trolley.sinks import to_messages

QUERIES = Registry()

_STORED = "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_mktsegment = 'BUILDING'"
_USERS_SELECT = ", ".join(
    "created_at AS registration_date" if name == "registration_date" else f'"{name}"'
    for name in USERS.fieldNames()
)
_FIRST_USERS = f"""
SELECT {_USERS_SELECT}
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY received, event_id) AS n
      FROM ({activity_sql(*USERS_PAYLOAD.fieldNames())}) AS a) AS ranked
WHERE n = 1"""


def stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment play the users already stored."""
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return customers.select(F.col("c_custkey").cast("string").alias("user_id"))


# --- decoding -------------------------------------------------------------------------------


@QUERIES.add(
    "SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, value, props FROM events"
)
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event as JSON bytes and back; the format keeps microseconds."""
    precise = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    events = events_of(spark, sf_dir)
    text = F.to_json(F.struct("*"), {"timestampNTZFormat": precise})
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    )
    return decode(envelope(events, text), schema).select(*schema.fieldNames())


@QUERIES.add(f"SELECT {field_sql()} FROM events")
def decode_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 38 fields of every message."""
    return zoneless(accepted(decode(messages(spark, sf_dir))).select(*ACTIVITY.fieldNames()))


_SMALL = """concat('{"user_id":"', user_id, '","session_duration":', event_id % 1800, '}')"""


# What errors send, in turn: objects without a key, the second after a line break, the last before
# other text; a raw line break within a string; single quotes; a scalar, null and an array.
_KEYLESS = """concat('{"session_duration":', event_id % 1800, '}')"""
_ERRORS = f"""CASE event_id % 8
    WHEN 1 THEN concat(chr(10), {_KEYLESS})
    WHEN 2 THEN concat('{{"user_id":"a', chr(10), 'b"}}')
    WHEN 3 THEN concat('{{', chr(39), 'user_id', chr(39), ':', chr(39), 'x', chr(39), '}}')
    WHEN 4 THEN '5'
    WHEN 5 THEN 'null'
    WHEN 6 THEN '[{{"user_id":"u"}}]'
    WHEN 7 THEN concat({_KEYLESS}, ' tail')
    ELSE {_KEYLESS} END"""


def _damaged(spark: SparkSession, sf_dir: str, waves: int = 1) -> DataFrame:
    """Clicks lose the closing brace, sign-ups their payload, errors send anything but a record."""
    value = F.expr(
        f"""CASE event_type
            WHEN 'click' THEN left({_SMALL}, length({_SMALL}) - 1)
            WHEN 'signup' THEN ''
            WHEN 'error' THEN {_ERRORS}
            ELSE {_SMALL} END"""
    )
    return envelope(events_of(spark, sf_dir, waves), value)


@QUERIES.add(
    f"""
SELECT CASE event_type WHEN 'click' THEN left({_SMALL}, length({_SMALL}) - 1)
                       WHEN 'signup' THEN ''
                       ELSE {_ERRORS} END AS raw_value,
       CASE event_type WHEN 'click' THEN 'malformed' WHEN 'signup' THEN 'empty'
           ELSE CASE WHEN event_id % 8 IN (2, 3) THEN 'malformed' ELSE 'no key' END END AS reason,
       CAST(event_id % 3 AS INTEGER) AS ingest_partition, event_id AS ingest_offset,
       {id_sql("quarantine")} AS quarantine_id
FROM events WHERE event_type IN ('click', 'signup', 'error')"""
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages with text and reason."""
    bad = rejected(decode(_damaged(spark, sf_dir), FACTS_PAYLOAD))
    return bad.select("raw_value", "reason", "ingest_partition", "ingest_offset", "quarantine_id")


@QUERIES.add(
    """
SELECT coalesce(reason, 'accepted') AS route, count(*) AS n
FROM (SELECT CASE event_type WHEN 'click' THEN 'malformed' WHEN 'signup' THEN 'empty'
                             WHEN 'error' THEN CASE WHEN event_id % 8 IN (2, 3) THEN 'malformed'
                                                    ELSE 'no key' END END AS reason FROM events) AS r
GROUP BY 1"""
)
def routing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message ends up accepted or rejected, never both."""
    routed = decode(_damaged(spark, sf_dir), FACTS_PAYLOAD)
    route = F.coalesce("reject_reason", F.lit("accepted")).alias("route")
    return routed.groupBy(route).agg(F.count(F.lit(1)).alias("n"))


@QUERIES.add("SELECT event_id AS \"offset\" FROM events WHERE event_type <> 'signup'")
def nonempty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a payload."""
    return drop_empty(_damaged(spark, sf_dir)).select("offset")


@QUERIES.add(
    """
SELECT CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_type = 'click' THEN NULL ELSE CAST(event_id % 1800 AS INTEGER) END AS session_duration,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS user_rating,
       event_type IN ('click', 'error') AS partial
FROM events"""
)
def partial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that cannot be read is null and flagged; the rest of the record survives."""
    records = accepted(_half_read(spark, sf_dir))
    return records.select("user_id", "session_duration", "user_rating", "partial")


_HALF = """concat('{"user_id":', user_id,
    ',"session_duration":', CASE event_type WHEN 'click' THEN '"oops"' ELSE CAST(event_id % 1800 AS VARCHAR(20)) END,
    ',"user_rating":', CASE event_type WHEN 'error' THEN '"nope"' ELSE CAST(value AS VARCHAR(40)) END, '}')"""


def _half_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrowed("session_duration", "user_rating")
    return decode(envelope(events_of(spark, sf_dir), F.expr(_HALF)), schema)


@QUERIES.add(
    f"""
SELECT {_HALF} AS raw_value, 'partial' AS reason, event_id AS ingest_offset, {id_sql("partial")} AS quarantine_id
FROM events WHERE event_type IN ('click', 'error')"""
)
def partial_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of accepted records that lost a field."""
    lost = partials(_half_read(spark, sf_dir))
    return lost.select("raw_value", "reason", "ingest_offset", "quarantine_id")


_PER_MESSAGE = 32


@QUERIES.add(
    f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, {FIELDS["product_id"]} AS product_id,
       event_id // {_PER_MESSAGE} AS ingest_offset,
       CAST(row_number() OVER (PARTITION BY event_id // {_PER_MESSAGE} ORDER BY event_id) - 1 AS INTEGER)
           AS ingest_item
FROM events"""
)
def array_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry an array of up to 32 records, taken apart again."""
    record = F.struct(
        "event_id",
        F.expr(FIELDS["user_id"]).alias("user_id"),
        F.expr(FIELDS["product_id"]).alias("product_id"),
    )
    # Event ids are unique, so an array cannot grow beyond its range of ids.
    chunk = F.floor(F.col("event_id") / _PER_MESSAGE).alias("event_id")
    chunks = (
        table(spark, sf_dir, "events")
        .groupBy(chunk)
        .agg(F.array_sort(F.collect_list(record)).alias("records"), F.min("ts").alias("ts"))
    )
    sent = envelope(chunks, F.to_json("records"))
    records = accepted(decode(sent, narrowed("product_id"), batched=True))
    return records.select("user_id", "product_id", "ingest_offset", "ingest_item")


# --- users ----------------------------------------------------------------------------------


@QUERIES.add("SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events")
def users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row distinct."""
    events = table(spark, sf_dir, "events")
    return distinct_rows(events.select(F.col("user_id").cast("string"), "event_type"))


_DISTINCT_NEW = f"""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events AS e
WHERE NOT EXISTS (SELECT 1 FROM ({_STORED}) AS s WHERE s.user_id = CAST(e.user_id AS VARCHAR))"""


@QUERIES.add(_DISTINCT_NEW)
def new_users_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows of users not stored yet."""
    return new_rows(users_distinct(spark, sf_dir), stored_users(spark, sf_dir), "user_id")


@QUERIES.add(_DISTINCT_NEW)
def new_users_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the stored users cut down to the batch's keys first."""
    events = table(spark, sf_dir, "events")
    return new_rows(
        users_distinct(spark, sf_dir),
        stored_users(spark, sf_dir),
        "user_id",
        strategy="semi_first",
        keys=events.select(F.col("user_id").cast("string")),
    )


@QUERIES.add(_FIRST_USERS)
def users_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, the earliest received."""
    records = accepted(decode(messages(spark, sf_dir, bounded=True), USERS_PAYLOAD))
    return zoneless(earliest_per_key(users(records, *ARRIVAL), "user_id"))


@QUERIES.add(
    f"""
SELECT * FROM ({_FIRST_USERS}) AS f
WHERE NOT EXISTS (SELECT 1 FROM ({_STORED}) AS s WHERE s.user_id = f.user_id)"""
)
def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to the rows that would be added to ``users``."""
    return new_rows(users_first_seen(spark, sf_dir), stored_users(spark, sf_dir), "user_id")


# --- facts ----------------------------------------------------------------------------------


def _facts_sql(kind: str, columns: str, day: str, day_column: str) -> str:
    return f"""
SELECT {columns}, {day} AS {day_column}, {id_sql(kind)} AS {kind}_id
FROM ({activity_sql(*FACTS_PAYLOAD.fieldNames())}) AS a"""


_INTERACTION_COLUMNS = "user_id, product_id, category_id, session_duration"
_FEEDBACK_COLUMNS = "user_id, product_id, feedback, user_rating AS rating"


def _fact_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(decode(messages(spark, sf_dir), FACTS_PAYLOAD))


@QUERIES.add(_facts_sql("interaction", _INTERACTION_COLUMNS, '"timestamp"', "interaction_date"))
def user_product_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(interactions(_fact_records(spark, sf_dir)))


@QUERIES.add(_facts_sql("interaction", _INTERACTION_COLUMNS, "received", "interaction_date"))
def interactions_by_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated by the broker's clock."""
    return zoneless(interactions(_fact_records(spark, sf_dir), clock="ingest"))


@QUERIES.add(_facts_sql("feedback", _FEEDBACK_COLUMNS, '"timestamp"', "feedback_date"))
def user_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(feedback(_fact_records(spark, sf_dir)))


@QUERIES.add(_facts_sql("feedback", _FEEDBACK_COLUMNS, "received", "feedback_date"))
def feedback_by_receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated by the broker's clock."""
    return zoneless(feedback(_fact_records(spark, sf_dir), clock="ingest"))


@QUERIES.add(_facts_sql("interaction", _INTERACTION_COLUMNS, '"timestamp"', "interaction_date"))
def dedup_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of purchases arrive twice and are kept once."""
    sent = messages(spark, sf_dir)
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    again = sent.join(bought.select(F.col("event_id").alias("offset")), "offset", "left_semi")
    records = accepted(decode(sent.unionByName(again), FACTS_PAYLOAD))
    return zoneless(drop_replays(interactions(records), "interaction_id"))


# --- checks ---------------------------------------------------------------------------------


def _sometimes(name: str, rest: int, value: str) -> str:
    return f"CASE WHEN event_id % 13 = {rest} THEN {value} ELSE {FIELDS[name]} END"


# The fields that rules look at, each outside its domain in some records.
_RULED = (
    "gender", "payment_method", "subscription_type", "customer_status", "annual_income",
    "transaction_amount", "session_duration", "user_rating", "date_of_birth", "timestamp",
)
_OUTSIDE = {
    **FIELDS,
    "gender": _sometimes("gender", 1, "'Unknown'"),
    "payment_method": _sometimes("payment_method", 2, "'Cash'"),
    "subscription_type": _sometimes("subscription_type", 3, "'Free'"),
    "customer_status": _sometimes("customer_status", 4, "'Gone'"),
    "annual_income": _sometimes("annual_income", 5, "19999"),
    "transaction_amount": _sometimes("transaction_amount", 6, "CAST(1000.125 AS DOUBLE)"),
    "user_rating": _sometimes("user_rating", 7, "CAST(5.25 AS DOUBLE)"),
}

_BROKEN = {
    "gender": "gender NOT IN ('Male', 'Female', 'Non-binary', 'Prefer not to say')",
    "payment_method": "payment_method NOT IN ('Credit Card', 'Debit Card', 'PayPal', 'Bank Transfer')",
    "subscription_type": "subscription_type NOT IN ('Basic', 'Premium', 'Enterprise')",
    "customer_status": "customer_status NOT IN ('Active', 'Inactive', 'Pending')",
    "annual_income": "annual_income NOT BETWEEN 20000 AND 150000",
    "transaction_amount": "transaction_amount NOT BETWEEN 1 AND 1000",
    "transaction_amount_scale": "transaction_amount <> round(transaction_amount, 2)",
    "session_duration": "session_duration NOT BETWEEN 1 AND 1800",
    "user_rating": "user_rating NOT BETWEEN 1 AND 5",
    "user_rating_scale": "user_rating <> round(user_rating, 1)",
    "age": "date_sub('year', date_of_birth, \"timestamp\") NOT BETWEEN 18 AND 90",
}


@QUERIES.add(
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS n_broken FROM (SELECT "
        + ", ".join(f'{_OUTSIDE[name]} AS "{name}"' for name in _RULED)
        + " FROM events) AS a"
        for rule, broken in _BROKEN.items()
    )
)
def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per broken rule; ages are counted at the time of the event."""
    sent = messages(spark, sf_dir, "user_id", *_RULED, fields=_OUTSIDE)
    records = accepted(decode(sent, narrowed(*_RULED)))
    return rule_violations(records, activity_rules(as_of=F.col("timestamp")))


@QUERIES.add(
    """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem AS l
WHERE NOT EXISTS (SELECT 1 FROM part AS p WHERE p.p_partkey = l.l_partkey AND p.p_size < 40)"""
)
def dimension_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose part is not among the smaller ones."""
    known = table(spark, sf_dir, "part").where("p_size < 40")
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return missing_references(facts, known.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@QUERIES.add(
    f"""
SELECT {id_sql("interaction")} AS interaction_id, product_id
FROM ({activity_sql("product_id")}) AS a
WHERE NOT EXISTS (SELECT 1 FROM part AS p WHERE CAST(p.p_partkey AS VARCHAR) = a.product_id)"""
)
def unknown_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions with a product that is not in the catalogue."""
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("product_id"))
    records = accepted(decode(messages(spark, sf_dir, "user_id", "product_id"), narrowed("product_id")))
    facts = records.select(record_id("interaction").alias("interaction_id"), "product_id")
    return missing_references(facts, products, "product_id").select("interaction_id", "product_id")


@QUERIES.add(
    f"""
SELECT 'product_id' AS reference, count(*) AS n_missing FROM ({activity_sql("product_id")}) AS a
WHERE NOT EXISTS (SELECT 1 FROM part AS p WHERE CAST(p.p_partkey AS VARCHAR) = a.product_id)
UNION ALL
SELECT 'category_id', count(*) FROM ({activity_sql("category_id")}) AS a
WHERE NOT EXISTS (SELECT 1 FROM nation AS n
                  WHERE n.n_regionkey < 3 AND concat('c', n.n_nationkey) = a.category_id)"""
)
def unknown_reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions per kind of reference that leads nowhere; nations of three regions play
    the categories."""
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("product_id"))
    categories = table(spark, sf_dir, "nation").where("n_regionkey < 3")
    categories = categories.select(F.concat(F.lit("c"), "n_nationkey").alias("category_id"))
    sent = messages(spark, sf_dir, "user_id", "product_id", "category_id")
    facts = accepted(decode(sent, narrowed("product_id", "category_id")))
    return missing_reference_counts(facts, {"product_id": products, "category_id": categories})


# --- output ---------------------------------------------------------------------------------


@QUERIES.add(
    """
SELECT concat('{"event_id":', event_id, ',"ts":"', strftime(ts, '%Y-%m-%d %H:%M:%S'),
              '","event_type":"', event_type, '","referrer":null}') AS "value"
FROM events"""
)
def kafka_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of outgoing messages, nulls included."""
    record = table(spark, sf_dir, "events").select(
        "event_id",
        wire_timestamp("ts").alias("ts"),
        "event_type",
        F.lit(None).cast("string").alias("referrer"),
    )
    return to_messages(record).select(F.col("value").cast("string").alias("value"))


@QUERIES.add(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS wire, date_trunc('second', ts) AS parsed FROM events"""
)
def wire_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps to wire text and back."""
    text = table(spark, sf_dir, "events").select("event_id", wire_timestamp("ts").alias("wire"))
    return text.select("*", F.to_timestamp_ntz("wire").alias("parsed"))


@QUERIES.add(
    """
SELECT event_id, concat('{"transaction_amount":', value, ',"gender":null}') AS record FROM events"""
)
def record_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record as JSON with the amount rounded to cents."""
    record = record_json(
        F.round("value", 2).alias("transaction_amount"), F.lit(None).cast("string").alias("gender")
    )
    return table(spark, sf_dir, "events").select("event_id", record.alias("record"))


@QUERIES.add("SELECT event_id, ts, user_id, event_type FROM events ORDER BY event_id LIMIT 5")
def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows logged before a write."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return sample_rows(events, 5, "event_id")


@QUERIES.add(
    f"""
SELECT 'users' AS table_name, count(DISTINCT user_id) AS n_rows FROM events
UNION ALL SELECT 'user_product_interactions', count(*) FROM events"""
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of curated tables, from one pass over the messages."""
    records = accepted(decode(messages(spark, sf_dir, "user_id"), narrowed()))
    counted = records.agg(
        F.count_distinct("user_id").alias("users"), F.count("*").alias("user_product_interactions")
    )
    return counted.unpivot([], counted.columns, "table_name", "n_rows")
