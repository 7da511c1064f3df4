"""The state of a query that remembers users: what it holds, and how to deal it out anew.

The number of state partitions is fixed for the life of a checkpoint. To change it, stop the query,
``export_state`` what it remembers, and start a query with another checkpoint, another number and
``kept_state``: the old state is the first thing it reads. Its messages start at
``committed_offsets`` of the old one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.sinks.files import children


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key``, ``value`` and ``partition_id`` of all that is remembered after the last batch."""
    return spark.read.format("statestore").load(checkpoint)


def remembered(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The records a query with ``remember_users`` keeps, with ``_window`` and ``_partition``."""
    rows = state_rows(spark, checkpoint)
    # the aggregate keeps the record first, and what it is compared by after it
    record = rows.schema["value"].dataType.fields[0].name
    return rows.select(
        F.col("key.window").alias("_window"), F.col("partition_id").alias("_partition"), f"value.{record}.*"
    )


def state_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``partition``, ``interval_start``, ``interval_end`` and ``n`` records: how even state is, and
    of which intervals. An interval is forgotten by the batch after the first one that arrives behind its end."""
    groups = (
        F.col("_partition").alias("partition"),
        F.col("_window.start").alias("interval_start"),
        F.col("_window.end").alias("interval_end"),
    )
    return remembered(spark, checkpoint).groupBy(*groups).agg(F.count("*").alias("n"))


def overdue(spark: SparkSession, checkpoint: str, now: Column | None = None) -> DataFrame:
    """Sizes of intervals that ended a whole interval ago and are still held: no batch has come
    since, or eviction does not work."""
    length = F.col("interval_end").cast("long") - F.col("interval_start").cast("long")
    at = F.unix_timestamp(F.current_timestamp() if now is None else now)
    return state_sizes(spark, checkpoint).where(F.col("interval_end").cast("long") + length <= at)


def export_state(spark: SparkSession, checkpoint: str, path: str) -> int:
    """Write what a stopped query remembers, for ``kept_state`` of another one; returns the rows."""
    kept = remembered(spark, checkpoint).drop("_window", "_partition")
    kept.write.mode("error").parquet(path)
    return spark.read.parquet(path).count()


def committed_offsets(spark: SparkSession, checkpoint: str, source: int = 0) -> str:
    """Where the source of a stopped query got to with its last finished batch, in the form that
    ``KafkaTopic.starting_offsets`` takes."""
    done = [int(name) for name in children(spark, f"{checkpoint}/commits") if name.isdecimal()]
    if not done:
        return "earliest"
    text = spark.read.text(f"{checkpoint}/offsets/{max(done)}", wholetext=True).first()[0]
    offset = text.split("\n")[2 + source]  # a version, then one line about the batch
    json.loads(offset)
    return offset
