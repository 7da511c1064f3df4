"""Jobs over file streams of Kafka-shaped rows."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from trolley.operators import accepted, decode, earliest_per_key, feedback, interactions, users
from trolley.operators.dedup import ARRIVAL
from trolley.schemas import (
    ACTIVITY,
    CURATED_PAYLOAD,
    FEEDBACK,
    INTERACTIONS,
    METRICS,
    QUARANTINE,
    USERS,
)
from trolley.sinks import BatchFolders, JdbcTable, ParquetTable
from trolley.sources import message_files
from trolley.streaming import (
    await_query,
    backfill,
    fan_out,
    land_json,
    land_parquet,
    land_rejects,
    start_all,
    start_facts,
    start_users,
    Targets,
)

DRAIN = {"availableNow": True}


def payload(user, n, **more):
    return json.dumps(
        {"user_id": user, "product_id": f"p{n}", "first_name": f"name {n}", "user_rating": 1.5, **more}
    )


class Inbox:
    """A folder that messages are delivered to, one file per delivery."""

    def __init__(self, spark, path, build):
        self.spark, self.path, self.build, self.offset = spark, path, build, 0

    def deliver(self, *payloads):
        rows = self.build(list(payloads), first=self.offset)
        self.offset += len(payloads)
        rows.coalesce(1).write.mode("append").parquet(self.path)
        return rows

    def stream(self):
        return message_files(self.spark, self.path, max_files=1)

    def batch(self):
        return message_files(self.spark, self.path, streaming=False)


@pytest.fixture
def box(spark, scratch, inbox):
    return Inbox(spark, f"{scratch}/inbox", inbox)


def names(table, spark):
    return sorted((r.user_id, r.first_name) for r in table.read(spark).collect())


def ids(table, spark, key):
    return sorted(r[0] for r in table.read(spark).select(key).collect())


class Failing:
    """A table that writes and then raises, as often as told."""

    def __init__(self, table, times=1):
        self.table, self.times = table, times

    def create(self, spark):
        self.table.create(spark)

    def read(self, spark):
        return self.table.read(spark)

    def stored(self, spark, key, days):
        return self.table.stored(spark, key, days)

    def write(self, rows, batch_id):
        self.table.write(rows, batch_id)
        if self.times:
            self.times -= 1
            raise RuntimeError("lost connection")


def test_users_key_cases(spark, scratch, box):
    table = ParquetTable(f"{scratch}/users", USERS)
    rejects = ParquetTable(f"{scratch}/rejects", QUARANTINE)

    def run():
        query = start_users(box.stream(), table, f"{scratch}/cp", quarantine=rejects, trigger=DRAIN)
        await_query(query)

    box.deliver(payload("a", 0), payload("b", 1), payload("a", 2), payload(None, 3), "{bad")
    run()
    assert names(table, spark) == [("a", "name 0"), ("b", "name 1")]
    box.deliver(payload("a", 5), payload("c", 6), payload("c", 7))
    box.deliver(payload("c", 8), payload("", 9))
    run()
    assert names(table, spark) == [("a", "name 0"), ("b", "name 1"), ("c", "name 6")]
    assert sorted(r.reason for r in rejects.read(spark).collect()) == ["malformed", "no key", "no key"]
    run()
    assert len(names(table, spark)) == 3


def test_earlier_message_later_in_the_file_wins(spark, scratch, inbox):
    late, early = inbox([payload("a", 1)], first=9), inbox([payload("a", 0)], first=3)
    table = ParquetTable(f"{scratch}/users", USERS)
    table.create(spark)
    decoded = decode(late.unionByName(early), CURATED_PAYLOAD)
    assert fan_out(decoded, 0, Targets(users=table)) == {"users": 1}
    assert names(table, spark) == [("a", "name 0")]


def test_stream_equals_batch(spark, scratch, box):
    for start in (0, 10, 20):
        box.deliver(*[payload(f"u{n % 7}", n) for n in range(start, start + 10)], "", "{bad")
    tables = [
        ParquetTable(f"{scratch}/users", USERS),
        ParquetTable(f"{scratch}/interactions", INTERACTIONS, by_day=True),
        BatchFolders(f"{scratch}/feedback", FEEDBACK),
    ]
    metrics = BatchFolders(f"{scratch}/metrics", METRICS)
    rejects = BatchFolders(f"{scratch}/rejects", QUARANTINE)
    query = start_all(
        box.stream(), *tables, f"{scratch}/cp", quarantine=rejects, metrics=metrics, trigger=DRAIN
    )
    await_query(query)
    records = accepted(decode(box.batch(), CURATED_PAYLOAD))
    expected = [
        earliest_per_key(users(records, *ARRIVAL), "user_id"),
        interactions(records),
        feedback(records),
    ]
    for table, rows in zip(tables, expected):
        stored = table.read(spark).select(*table.schema.fieldNames())
        assert stored.exceptAll(rows).count() == 0 and rows.exceptAll(stored).count() == 0
    counted = {
        r.table_name: r.n
        for r in metrics.read(spark).groupBy("table_name").agg(F.sum("n_rows").alias("n")).collect()
    }
    assert counted == {
        "users": 7,
        "user_product_interactions": 30,
        "user_feedback": 30,
        "quarantine": 6,
    }
    # Rows in are rows curated plus rows rejected.
    assert box.batch().count() == 30 + 6


@pytest.mark.parametrize("kind", ["append", "by_day", "folders", "jdbc"])
def test_sink_failure_is_retried_without_doubles(spark, scratch, box, derby, kind):
    table = {
        "append": lambda: ParquetTable(f"{scratch}/t", INTERACTIONS),
        "by_day": lambda: ParquetTable(f"{scratch}/t", INTERACTIONS, by_day=True),
        "folders": lambda: BatchFolders(f"{scratch}/t", INTERACTIONS),
        "jdbc": lambda: JdbcTable(derby, "t", INTERACTIONS, column_types="interaction_id varchar(64)"),
    }[kind]()
    flaky = Failing(table)
    box.deliver(*[payload("a", n) for n in range(20)])
    box.deliver(*[payload("b", n) for n in range(20)])
    start = lambda: start_facts(box.stream(), flaky, None, f"{scratch}/cp", trigger=DRAIN)
    with pytest.raises(StreamingQueryException):
        await_query(start())
    await_query(start())
    stored = ids(table, spark, "interaction_id")
    assert len(stored) == 40 == len(set(stored))


def test_failed_users_are_retried(spark, scratch, box):
    table = ParquetTable(f"{scratch}/users", USERS)
    flaky = Failing(table)
    box.deliver(*[payload(f"u{n % 5}", n) for n in range(20)])
    start = lambda: start_users(box.stream(), flaky, f"{scratch}/cp", trigger=DRAIN)
    with pytest.raises(StreamingQueryException):
        await_query(start())
    await_query(start())
    assert names(table, spark) == [(f"u{n}", f"name {n}") for n in range(5)]


def test_lost_checkpoint_replays_without_doubles(spark, scratch, box):
    tables = [
        ParquetTable(f"{scratch}/users", USERS),
        ParquetTable(f"{scratch}/interactions", INTERACTIONS, by_day=True),
        ParquetTable(f"{scratch}/feedback", FEEDBACK),
    ]
    for start in (0, 10):
        box.deliver(*[payload(f"u{n % 3}", n) for n in range(start, start + 10)])
    seen = []
    for run in ("first", "second"):
        await_query(start_all(box.stream(), *tables, f"{scratch}/{run}", trigger=DRAIN))
        seen.append([sorted(map(str, t.read(spark).collect())) for t in tables])
    assert seen[0] == seen[1]
    assert [len(rows) for rows in seen[0]] == [3, 20, 20]


def test_replayed_messages_within_and_across_batches(spark, scratch, box):
    table = ParquetTable(f"{scratch}/t", FEEDBACK)
    sent = box.deliver(*[payload("a", n) for n in range(10)])
    sent.unionByName(sent).coalesce(1).write.mode("append").parquet(box.path)
    await_query(start_facts(box.stream(), None, table, f"{scratch}/cp", trigger=DRAIN))
    stored = ids(table, spark, "feedback_id")
    assert len(stored) == 10 == len(set(stored))


@pytest.mark.parametrize("max_broadcast_bytes", [0, 20_000, 1 << 20])
def test_one_user_holding_most_rows(spark, scratch, box, max_broadcast_bytes):
    """Keys are never broadcast, only once made distinct, or as they are."""
    table, facts = ParquetTable(f"{scratch}/u", USERS), ParquetTable(f"{scratch}/i", INTERACTIONS)
    said = ParquetTable(f"{scratch}/f", FEEDBACK)
    box.deliver(*[payload("hot" if n % 3 else f"u{n}", n) for n in range(300)])
    query = start_all(
        box.stream(),
        table,
        facts,
        said,
        f"{scratch}/cp",
        trigger=DRAIN,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    await_query(query)
    expected = sorted([("hot", "name 1"), *((f"u{n}", f"name {n}") for n in range(0, 300, 3))])
    assert names(table, spark) == expected
    assert facts.read(spark).count() == said.read(spark).count() == 300


def test_staged_batches_give_the_same(spark, scratch, box):
    box.deliver(*[payload(f"u{n % 4}", n) for n in range(12)], "{bad")
    box.deliver(*[payload(f"u{n % 6}", n) for n in range(12)])
    found = {}
    for staging in (None, f"{scratch}/staging"):
        root = f"{scratch}/{'staged' if staging else 'held'}"
        tables = [
            ParquetTable(f"{root}/u", USERS),
            ParquetTable(f"{root}/i", INTERACTIONS),
            ParquetTable(f"{root}/f", FEEDBACK),
        ]
        query = start_all(
            box.stream(), *tables, f"{root}/cp", trigger=DRAIN, staging=staging, samples=2, clock="ingest"
        )
        await_query(query)
        found[staging] = [sorted(map(str, t.read(spark).collect())) for t in tables]
    first, second = found.values()
    assert first == second and [len(rows) for rows in first] == [6, 24, 24]


def test_remembered_users(spark, scratch, box):
    table = ParquetTable(f"{scratch}/users", USERS)
    rejects = ParquetTable(f"{scratch}/rejects", QUARANTINE)
    box.deliver(payload("a", 0), payload("b", 1), "{bad", "{worse")
    box.deliver(payload("a", 2), payload("c", 3), "")
    query = start_users(
        box.stream(),
        table,
        f"{scratch}/cp",
        quarantine=rejects,
        trigger=DRAIN,
        remember_users="1 hour",
        n_state_partitions=3,
    )
    await_query(query)
    state = query.lastProgress.stateOperators[0]
    assert state.numShufflePartitions == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert names(table, spark) == [("a", "name 0"), ("b", "name 1"), ("c", "name 3")]
    assert rejects.read(spark).count() == 3
    with pytest.raises(ValueError):
        start_facts(box.stream(), rejects, None, f"{scratch}/other", remember_users="1 hour")


def test_checkpoint_is_required(spark, box, scratch):
    box.deliver(payload("a", 0))
    table = ParquetTable(f"{scratch}/t", USERS)
    for start in (
        lambda: start_users(box.stream(), table, ""),
        lambda: land_json(box.stream(), f"{scratch}/x", ""),
        lambda: land_parquet(box.stream(), f"{scratch}/x", ""),
    ):
        with pytest.raises(ValueError):
            start()


def test_empty_batch_writes_nothing(spark, scratch, inbox):
    table = ParquetTable(f"{scratch}/users", USERS)
    table.create(spark)
    assert fan_out(decode(inbox(["x"]).limit(0), CURATED_PAYLOAD), 0, Targets(users=table)) == {}


def test_bytes_that_are_not_utf8(spark, scratch, inbox):
    broken = F.concat(F.lit(b'{"user_id":"'), F.lit(b"\xff"), F.lit(b'"}'))
    inbox(["x", '{"user_id":"a"}']).withColumn(
        "value", F.when(F.col("offset") == 0, broken).otherwise(F.col("value"))
    ).write.parquet(f"{scratch}/in")
    stream = lambda: message_files(spark, f"{scratch}/in")
    await_query(land_json(stream(), f"{scratch}/out", f"{scratch}/c1", trigger=DRAIN))
    assert [r.value for r in spark.read.text(f"{scratch}/out").collect()] == ['{"user_id":"a"}']
    await_query(
        land_rejects(stream(), f"{scratch}/no", f"{scratch}/c2", trigger=DRAIN, keep="payload")
    )
    rejects = spark.read.schema(QUARANTINE).parquet(f"{scratch}/no")
    assert [r.ingest_offset for r in rejects.select("ingest_offset").collect()] == [0]


def test_backfill_completes_what_a_stream_began(spark, scratch, box):
    tables = [
        ParquetTable(f"{scratch}/users", USERS),
        ParquetTable(f"{scratch}/interactions", INTERACTIONS, by_day=True),
        ParquetTable(f"{scratch}/feedback", FEEDBACK),
    ]
    box.deliver(*[payload(f"u{n % 3}", n) for n in range(10)])
    await_query(start_all(box.stream(), *tables, f"{scratch}/cp", trigger=DRAIN))
    box.deliver(*[payload(f"u{n % 5}", n) for n in range(10)])
    added = backfill(box.batch(), Targets(*tables), staging=f"{scratch}/staging")
    assert added == {"users": 2, "user_product_interactions": 10, "user_feedback": 10}
    assert set(backfill(box.batch(), Targets(*tables), repeats=False).values()) == {0}


def test_interval_trigger(spark, scratch, box):
    table = ParquetTable(f"{scratch}/users", USERS)
    box.deliver(payload("a", 0))
    query = start_users(box.stream(), table, f"{scratch}/cp", trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert names(table, spark) == [("a", "name 0")]
    finally:
        query.stop()
    assert not query.isActive


def test_landing(spark, scratch, box):
    texts = [
        '{"user_id":"a","unknown":[1,2],\n "annual_income":7}',
        '{"feedback":"no key"}',
        "[1]",
        "{bad",
        None,
        '{"user_id":"b"} trailing',
    ]
    box.deliver(*texts)
    await_query(land_json(box.stream(), f"{scratch}/raw", f"{scratch}/c1", trigger=DRAIN))
    lines = [json.loads(r.value) for r in spark.read.text(f"{scratch}/raw").collect()]
    assert sorted(map(str, lines)) == sorted(
        ["{'user_id': 'a', 'unknown': [1, 2], 'annual_income': 7}", "{'feedback': 'no key'}", "[1]"]
    )
    await_query(
        land_parquet(box.stream(), f"{scratch}/pq", f"{scratch}/c2", trigger=DRAIN, by_day=True)
    )
    landed = spark.read.schema(ACTIVITY).parquet(f"{scratch}/pq")
    assert sorted((r.user_id or "", r.feedback or "") for r in landed.collect()) == [
        ("", "no key"),
        ("a", ""),
        ("b", ""),
    ]
    await_query(land_rejects(box.stream(), f"{scratch}/no", f"{scratch}/c3", trigger=DRAIN))
    rejects = spark.read.schema(QUARANTINE).parquet(f"{scratch}/no")
    assert sorted(r.reason for r in rejects.collect()) == ["empty", "malformed", "no key"]
    await_query(
        land_json(box.stream(), f"{scratch}/f", f"{scratch}/c4", trigger=DRAIN, keep="fields")
    )
    await_query(
        land_rejects(box.stream(), f"{scratch}/np", f"{scratch}/c5", trigger=DRAIN, keep="payload")
    )
    rejects = spark.read.schema(QUARANTINE).parquet(f"{scratch}/np").collect()
    assert sorted((r.reason, r.raw_value) for r in rejects if r.raw_value) == [
        ("malformed", '{"user_id":"b"} trailing'),
        ("malformed", "{bad"),
    ]
    assert len(rejects) == 3
    row = json.loads(spark.read.text(f"{scratch}/f").where("value like '%\"a\"%'").first()[0])
    assert sorted(row) == ACTIVITY.fieldNames() and row["annual_income"] == 7
