"""Message bytes -> flat records with their source coordinates, good and bad told apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions import is_object, is_one_json, record_id
from trolley.functions.wire import READ_OPTIONS
from trolley.schemas import ACTIVITY, COORDINATES, QUARANTINE

_CORRUPT = "_corrupt_record"
_READ_OPTIONS = {**READ_OPTIONS, "columnNameOfCorruptRecord": _CORRUPT}
_BLANK = " \t\r\n"


def drop_empty(messages: DataFrame) -> DataFrame:
    """Messages that carry a payload at all."""
    return messages.where(F.col("value").isNotNull() & (F.octet_length("value") > 0))


def decode(
    messages: DataFrame, schema: T.StructType = ACTIVITY, *, batched: bool = False
) -> DataFrame:
    """Parse Kafka-shaped rows into one flat row per record.

    Besides the fields of ``schema`` a row has the ``COORDINATES`` columns and

    - ``reject_reason``: null for a usable record, else ``empty``, ``malformed`` or ``no key``;
    - ``raw_value``: the record's text, only kept where it was rejected or is partial;
    - ``partial``: some field of a usable record could not be read and is null.

    ``batched`` also accepts messages that hold a JSON array: every element becomes a row
    of its own and is judged on its own.

    ``explode`` around the parse is deliberate. Optimizer rules push filters through a
    projection by copying the expression, which would parse the text once per condition;
    they do not push them through a generator.
    """
    rows = _received(messages)
    rows = _split_arrays(rows) if batched else rows
    readable = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = rows.select(
        *COORDINATES.fieldNames(),
        "raw",
        F.explode(F.array(F.from_json("raw", readable, _READ_OPTIONS))).alias("data"),
    )
    has_key = _has_key(F.col("data.user_id"))
    is_partial = has_key & F.col(f"data.{_CORRUPT}").isNotNull()
    reason = _reject_reason(F.col("raw"), has_key)
    return parsed.select(
        *[F.col(f"data.{name}").alias(name) for name in schema.fieldNames()],
        *COORDINATES.fieldNames(),
        reason.alias("reject_reason"),
        F.when(~has_key | is_partial, F.col("raw")).alias("raw_value"),
        is_partial.alias("partial"),
    )


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages known not to be JSON, shaped like decoded records that were rejected."""
    rows = _received(messages)
    empty = F.coalesce(F.octet_length("raw"), F.lit(0)) == 0
    return rows.select(
        F.lit(None).cast("string").alias("user_id"),
        *COORDINATES.fieldNames(),
        F.when(empty, "empty").otherwise("malformed").alias("reject_reason"),
        F.col("raw").alias("raw_value"),
    )


def _received(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("topic").alias("ingest_topic"),
        F.col("partition").alias("ingest_partition"),
        F.col("offset").alias("ingest_offset"),
        F.lit(None).cast("int").alias("ingest_item"),
        F.col("timestamp").alias("ingest_ts"),
        F.col("value").cast("string").alias("raw"),
    )


def _split_arrays(rows: DataFrame) -> DataFrame:
    """One row per array element; anything else, malformed or empty arrays included, stays whole."""
    elements = F.when(
        F.ltrim("raw", F.lit(_BLANK)).startswith("["),
        F.from_json("raw", T.ArrayType(T.StringType()), READ_OPTIONS),
    )
    split = rows.drop("ingest_item").select("*", F.posexplode_outer(elements).alias("ingest_item", "element"))
    text = F.when(F.col("ingest_item").isNull(), F.col("raw")).otherwise(F.col("element"))
    return split.select(*COORDINATES.fieldNames(), text.alias("raw"))


def _has_key(user_id: Column) -> Column:
    return F.coalesce(F.length(user_id) > 0, F.lit(False))


def _reject_reason(raw: Column, has_key: Column) -> Column:
    """The text is parsed once more only where no key was found."""
    return (
        F.when(has_key, F.lit(None).cast("string"))
        .when(F.coalesce(F.length(raw), F.lit(0)) == 0, F.lit("empty"))
        .when(~is_object(raw) & ~is_one_json(raw), F.lit("malformed"))
        .otherwise(F.lit("no key"))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Records with a key."""
    return decoded.where(_has_key(F.col("user_id"))).drop("reject_reason", "raw_value")


def rejected(decoded: DataFrame) -> DataFrame:
    """The quarantine rows: every record without a key, with its text and the reason."""
    return (
        decoded.where(~_has_key(F.col("user_id")))
        .withColumnRenamed("reject_reason", "reason")
        .withColumn("quarantine_id", record_id("quarantine"))
        .select(*QUARANTINE.fieldNames())
    )


def partials(decoded: DataFrame) -> DataFrame:
    """Quarantine-like rows for accepted records that lost a field: their text, reason ``partial``."""
    return (
        decoded.where("partial")
        .withColumn("reason", F.lit("partial"))
        .withColumn("quarantine_id", record_id("partial"))
        .select(*QUARANTINE.fieldNames())
    )
