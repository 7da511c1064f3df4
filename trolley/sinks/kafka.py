"""Records as JSON messages on a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions import record_json


def to_messages(records: DataFrame) -> DataFrame:
    """A null key and the whole row as JSON, the two columns the Kafka sink takes."""
    return records.select(
        F.lit(None).cast("binary").alias("key"), record_json().cast("binary").alias("value")
    )


def publish(
    records: DataFrame, bootstrap_servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Send every row of a batch frame."""
    (
        to_messages(records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )
