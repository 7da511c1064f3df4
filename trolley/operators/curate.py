"""Projections of accepted records onto the curated tables."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions import record_id
from trolley.schemas import FEEDBACK, INTERACTIONS, USERS

# ``event``: when the shopper acted, as the payload says. ``ingest``: when the broker
# received the message.
Clock = Literal["event", "ingest"]


def clock_column(clock: Clock) -> Column:
    columns = {"event": "timestamp", "ingest": "ingest_ts"}
    if clock not in columns:
        raise ValueError(f"clock must be one of {sorted(columns)}, not {clock!r}")
    return F.col(columns[clock])


def users(records: DataFrame, *keep: str) -> DataFrame:
    """The ``users`` columns, plus any columns named in ``keep``."""
    renamed = records.withColumn("registration_date", F.col("created_at"))
    return renamed.select(*USERS.fieldNames(), *keep)


def interactions(records: DataFrame, *keep: str, clock: Clock = "event") -> DataFrame:
    """One ``user_product_interactions`` row per record."""
    return records.select(
        "*",
        clock_column(clock).alias("interaction_date"),
        record_id("interaction").alias("interaction_id"),
    ).select(*INTERACTIONS.fieldNames(), *keep)


def feedback(records: DataFrame, *keep: str, clock: Clock = "event") -> DataFrame:
    """One ``user_feedback`` row per record."""
    return records.select(
        "*",
        F.col("user_rating").alias("rating"),
        clock_column(clock).alias("feedback_date"),
        record_id("feedback").alias("feedback_id"),
    ).select(*FEEDBACK.fieldNames(), *keep)
