"""How the messages behind a query are dealt out to tasks."""

import pytest
from pyspark.sql import functions as F

from trolley import plans
from trolley.plans import inputs
from plan_text import plan_of


@pytest.fixture
def events(spark, scratch):
    """2,000 events of 20 users in one file; the first of a user is the one with the lowest id."""
    rows = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("event_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (F.col("id") % 20).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{scratch}/events.parquet")
    return scratch


def test_tasks_that_sort_messages_get_no_more_as_the_table_grows(spark, events, monkeypatch):
    monkeypatch.setattr(inputs, "PIECE_ROWS", 100, raising=False)
    first = plans.queries()["users_first_seen"](spark, events)
    assert "rangepartitioning(event_id" in plan_of(first)
    assert sorted(row.email for row in first.collect()) == sorted(f"u{n}.{n}@example.com" for n in range(20))
    held = inputs.messages(spark, events, "user_id", bounded=True).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in held.collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200


def test_small_tables_are_dealt_out_as_before(spark, events):
    pieces = inputs.messages(spark, events, "user_id", bounded=True).rdd.getNumPartitions()
    assert pieces == inputs.messages(spark, events, "user_id").rdd.getNumPartitions()
