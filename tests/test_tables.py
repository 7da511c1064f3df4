"""Parquet, batch-folder, JDBC and Kafka sinks, and the JDBC sources."""

import datetime
import json
import re
import string

import pytest
from plan_text import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trolley.schemas import FEEDBACK, METRICS, USERS
from trolley.sinks import BatchFolders, JdbcTable, ParquetTable, publish, to_messages
from trolley.sources import (
    Jdbc,
    KafkaTopic,
    column_bounds,
    key_ranges,
    read_query,
    read_table,
    read_topic,
    stream_topic,
)


def facts(spark, *rows):
    """Feedback rows of (id, day received)."""
    df = spark.createDataFrame(list(rows), "feedback_id string, day string")
    return df.select(
        *[
            F.col("feedback_id") if f.name == "feedback_id" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in FEEDBACK
        ],
        F.to_timestamp("day").alias("ingest_ts"),
    )


def test_parquet_table_by_day(spark, scratch):
    table = ParquetTable(scratch, FEEDBACK, by_day=True, rebalance=True)
    table.create(spark)
    assert table.read(spark).count() == 0
    table.write(facts(spark, ("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)))
    table.create(spark)
    assert table.read(spark).count() == 3
    day = datetime.date(2024, 1, 2)
    stored = table.stored(spark, "feedback_id", (day, day))
    assert sorted(r.feedback_id for r in stored.collect()) == ["b", "c"]
    assert re.search(r"PartitionFilters: \[[^]]*ingest_day", plan_of(stored))
    assert "ReadSchema: struct<feedback_id:string>" in plan_of(stored)


def test_batch_folders_replace(spark, scratch):
    table = BatchFolders(scratch, METRICS)
    table.create(spark)
    assert table.read(spark).count() == 0
    for n in (5, 7):
        table.write(spark.createDataFrame([(3, "users", n)], METRICS), 3)
    assert [tuple(r) for r in table.read(spark).select("batch_id", "n_rows").collect()] == [(3, 7)]


def test_jdbc_table(spark, derby):
    table = JdbcTable(derby, "feedback", FEEDBACK, column_types="feedback_id varchar(64)")
    table.create(spark)
    assert table.read(spark).count() == 0
    table.write(facts(spark, ("a", None), ("b", None)))
    table.create(spark)
    assert sorted(r.feedback_id for r in table.stored(spark, "feedback_id", None).collect()) == ["a", "b"]
    assert table.read(spark).columns == FEEDBACK.fieldNames()


@pytest.fixture
def numbers(spark, derby):
    rows = spark.range(100).select(
        "id", F.format_string("%02x", "id").alias("user_id"), F.lit(1.5).alias("x")
    )
    JdbcTable(derby, "numbers", rows.schema, column_types="user_id varchar(64)").write(rows)
    return "numbers"


def test_jdbc_partitioned_read(spark, derby, numbers):
    lo, hi = column_bounds(spark, derby, numbers, "id")
    assert (lo, hi) == (0, 99)
    df = read_table(spark, derby, numbers, ["id"], partition=("id", lo, hi, 4))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert "ReadSchema: struct<id:bigint>" in plan_of(df)


def test_jdbc_key_ranges_cover_all(spark, derby, numbers):
    ranges = key_ranges(derby, "user_id")
    df = read_table(spark, derby, numbers, predicates=ranges)
    assert df.rdd.getNumPartitions() == len(string.hexdigits[:16])
    assert sorted(r.id for r in df.collect()) == list(range(100))
    # Derby refuses nulls in a column Spark takes for a CLOB, so this is only read off.
    assert ranges[0].endswith("IS NULL)")
    assert key_ranges(derby, "user_id", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        read_table(spark, derby, numbers, partition=("id", 0, 1, 2), predicates=ranges)


def test_jdbc_query(spark, derby, numbers):
    df = read_query(spark, derby, f'SELECT "id" FROM {numbers} WHERE "id" < 3')
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]


def test_jdbc_filter_is_pushed_down(spark, derby, numbers):
    df = read_table(spark, derby, numbers).where("user_id = '0a'")
    assert "EqualTo(user_id,0a)" in plan_of(df) and df.count() == 1


def test_quoting():
    assert Jdbc("jdbc:mysql://h/d").quote("a`b") == "`a``b`"
    assert Jdbc("jdbc:derby:x").quote('a"b') == '"a""b"'
    assert key_ranges(Jdbc("jdbc:derby:x"), "k", ["o'b"])[1] == "(\"k\" >= 'o''b')"


def test_credentials_stay_out_of_repr():
    assert "secret" not in repr(Jdbc("jdbc:derby:x", options={"password": "secret"}))


def test_topic_options():
    topic = KafkaTopic("b:9092", "t", group_id="g", max_offsets=10, min_partitions=6, options={"kafka.x": "y"})
    assert topic.reader_options(streaming=True) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.group.id": "g",
        "minPartitions": "6",
        "maxOffsetsPerTrigger": "10",
        "kafka.x": "y",
    }
    assert "maxOffsetsPerTrigger" not in topic.reader_options(streaming=False)


def test_kafka_needs_its_connector(spark):
    """The connector is not installed here, so only the way up to it can be tested."""
    topic = KafkaTopic("nowhere:9092", "t")
    for attempt in (
        lambda: stream_topic(spark, topic),
        lambda: read_topic(spark, topic),
        lambda: publish(spark.range(1), "nowhere:9092", "t"),
    ):
        with pytest.raises(AnalysisException, match="kafka"):
            attempt()


def test_messages(spark):
    sent = to_messages(spark.sql("SELECT 'a' AS user_id, CAST(NULL AS INT) AS n"))
    assert [f.dataType.typeName() for f in sent.schema] == ["binary", "binary"]
    row = sent.first()
    assert row.key is None and json.loads(bytes(row.value)) == {"user_id": "a", "n": None}


def test_users_refuse_batch_folders():
    from trolley.streaming import Targets

    with pytest.raises(ValueError):
        Targets(users=BatchFolders("x", USERS))
