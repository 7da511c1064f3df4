"""Schemas of the activity record, the message envelope and the curated tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}

# Names and types of the activity record on the wire, alphabetical.
_ACTIVITY_FIELDS = """
address string
annual_income int
bank_account_number string
category_id string
city string
company_name string
country string
created_at timestamp
credit_card_expiry string
credit_card_number string
customer_review string
customer_status string
date_of_birth timestamp
email string
feedback string
first_name string
gender string
job_title string
last_login timestamp
last_name string
latitude string
longitude string
nationality string
payment_method string
phone_number string
product_id string
session_duration int
start_date timestamp
subscription_type string
timestamp timestamp
transaction_amount double
transaction_date timestamp
twitter_handle string
updated_at timestamp
user_id string
user_rating double
username string
website_url string
"""

ACTIVITY = T.StructType(
    [
        T.StructField(name, _TYPES[kind])
        for name, kind in (line.split() for line in _ACTIVITY_FIELDS.strip().splitlines())
    ]
)

# The columns every Kafka source yields.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Where a decoded record came from. ``ingest_item`` is the position inside a message
# that carries an array, null for a message that carries one object.
COORDINATES = T.StructType(
    [
        T.StructField("ingest_topic", T.StringType()),
        T.StructField("ingest_partition", T.IntegerType()),
        T.StructField("ingest_offset", T.LongType()),
        T.StructField("ingest_item", T.IntegerType()),
        T.StructField("ingest_ts", T.TimestampType()),
    ]
)


def _pick(source: T.StructType, *names: str, **renamed: str) -> list[T.StructField]:
    fields = [source[name] for name in names]
    fields += [T.StructField(new, source[old].dataType) for new, old in renamed.items()]
    return fields


USERS = T.StructType(
    _pick(ACTIVITY, "user_id", "first_name", "last_name", registration_date="created_at")
    + _pick(
        ACTIVITY,
        "email",
        "phone_number",
        "address",
        "date_of_birth",
        "gender",
        "nationality",
        "job_title",
        "company_name",
        "start_date",
        "username",
        "website_url",
        "twitter_handle",
        "country",
        "city",
        "subscription_type",
        "customer_status",
    )
)

INTERACTIONS = T.StructType(
    _pick(
        ACTIVITY,
        "user_id",
        "product_id",
        "category_id",
        "session_duration",
        interaction_date="timestamp",
    )
    + [T.StructField("interaction_id", T.StringType())]
)

FEEDBACK = T.StructType(
    _pick(
        ACTIVITY,
        "user_id",
        "product_id",
        "feedback",
        rating="user_rating",
        feedback_date="timestamp",
    )
    + [T.StructField("feedback_id", T.StringType())]
)

QUARANTINE = T.StructType(
    [
        T.StructField("raw_value", T.StringType()),
        T.StructField("reason", T.StringType()),
        *COORDINATES.fields,
        T.StructField("quarantine_id", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def narrowed(*fields: str) -> T.StructType:
    """The activity schema cut down to ``fields``; ``user_id`` is always kept.

    ``from_json`` only skips unread fields by itself when a single one is read, so a job
    that needs a few of them should ask for a narrow schema up front.
    """
    wanted = {"user_id", *fields}
    unknown = wanted.difference(ACTIVITY.fieldNames())
    if unknown:
        raise ValueError(f"not activity fields: {sorted(unknown)}")
    return T.StructType([f for f in ACTIVITY if f.name in wanted])


_USERS_INPUT = [name for name in USERS.fieldNames() if name != "registration_date"] + ["created_at"]
_INTERACTIONS_INPUT = ["product_id", "category_id", "session_duration", "timestamp"]
_FEEDBACK_INPUT = ["product_id", "feedback", "user_rating", "timestamp"]

USERS_PAYLOAD = narrowed(*_USERS_INPUT)
FACTS_PAYLOAD = narrowed(*_INTERACTIONS_INPUT, *_FEEDBACK_INPUT)
# Everything any curated table needs; card and bank numbers are not parsed at all.
CURATED_PAYLOAD = narrowed(*_USERS_INPUT, *_INTERACTIONS_INPUT, *_FEEDBACK_INPUT)
