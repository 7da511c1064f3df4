"""State that is read, audited and dealt out anew."""

import json

import pytest
from pyspark.sql import functions as F

from trolley.schemas import QUARANTINE, USERS
from trolley.sinks import BatchFolders, ParquetTable
from trolley.sources import message_files
from trolley.streaming import (
    committed_offsets,
    export_state,
    overdue,
    remembered,
    start_facts,
    start_users,
    state_sizes,
)

DRAIN = {"availableNow": True}


def deliver(spark, inbox, path, payloads, first):
    inbox([p if p.startswith("{b") else '{"user_id":"%s"}' % p for p in payloads], first=first).write.mode("append").parquet(path)
    return message_files(spark, path)


def run(spark, stream, scratch, label, n, **options):
    query = start_users(
        stream, ParquetTable(f"{scratch}/users", USERS), f"{scratch}/{label}",
        quarantine=ParquetTable(f"{scratch}/rejects", QUARANTINE), metrics=None,
        trigger=DRAIN, remember_users="300 days", n_state_partitions=n, **options,
    )
    query.awaitTermination()
    return query


def test_from_four_partitions_to_seven(spark, scratch, inbox):
    first = deliver(spark, inbox, f"{scratch}/in1", ["a", "b", "a", "{bad"], 0)
    run(spark, first, scratch, "cp4", 4)
    state = remembered(spark, f"{scratch}/cp4")
    assert sorted(r.user_id for r in state.where("user_id IS NOT NULL").collect()) == ["a", "b"]
    assert {r.ingest_offset for r in state.collect()} == {0, 1, 3}
    assert export_state(spark, f"{scratch}/cp4", f"{scratch}/kept") == 3

    second = deliver(spark, inbox, f"{scratch}/in2", ["b", "c", "a", "{bad"], 4)
    query = run(spark, second, scratch, "cp7", 7, kept_state=f"{scratch}/kept")
    assert query.lastProgress.stateOperators[0].numShufflePartitions == 7
    state = {(r.user_id, r.ingest_offset) for r in remembered(spark, f"{scratch}/cp7").collect()}
    assert state == {("a", 0), ("b", 1), (None, 3), ("c", 5), (None, 7)}
    users = ParquetTable(f"{scratch}/users", USERS).read(spark)
    assert sorted(r.user_id for r in users.collect()) == ["a", "b", "c"]
    assert ParquetTable(f"{scratch}/rejects", QUARANTINE).read(spark).count() == 2

    third = deliver(spark, inbox, f"{scratch}/in2", ["c", "d"], 8)  # the new query goes on by itself
    run(spark, third, scratch, "cp7", 7, kept_state=f"{scratch}/kept")
    assert sorted(r.user_id for r in ParquetTable(f"{scratch}/users", USERS).read(spark).collect()) == ["a", "b", "c", "d"]


def test_old_state_reaches_no_batch(spark, scratch, inbox):
    first = deliver(spark, inbox, f"{scratch}/in1", ["a", "b"], 0)
    run(spark, first, scratch, "cp", 2)
    export_state(spark, f"{scratch}/cp", f"{scratch}/kept")
    second = deliver(spark, inbox, f"{scratch}/in2", ["a", "b", "c"], 2)
    metrics = BatchFolders(f"{scratch}/rows", QUARANTINE)
    seen = []
    start = start_users(
        second, ParquetTable(f"{scratch}/other", USERS), f"{scratch}/cp2", quarantine=metrics, trigger=DRAIN,
        remember_users="300 days", n_state_partitions=3, kept_state=f"{scratch}/kept",
    )
    start.awaitTermination()
    seen = [r.user_id for r in ParquetTable(f"{scratch}/other", USERS).read(spark).collect()]
    assert seen == ["c"]  # a table that never saw the others gets none of them


def test_sizes_and_overdue_intervals(spark, scratch, inbox):
    run(spark, deliver(spark, inbox, f"{scratch}/in", [f"u{i}" for i in range(40)], 0), scratch, "cp", 3)
    sizes = state_sizes(spark, f"{scratch}/cp").collect()
    assert sum(r.n for r in sizes) == 40 and {r.partition for r in sizes} == {0, 1, 2}
    assert overdue(spark, f"{scratch}/cp").count() == 0
    later = F.current_timestamp() + F.expr("INTERVAL '700' DAY")
    assert overdue(spark, f"{scratch}/cp", later).agg(F.sum("n")).first()[0] == 40


def test_where_a_query_stopped(spark, scratch, inbox):
    stream = deliver(spark, inbox, f"{scratch}/in", ["a"], 0)
    run(spark, stream, scratch, "cp", 2)
    assert json.loads(committed_offsets(spark, f"{scratch}/cp")) == {"logOffset": 0}
    assert committed_offsets(spark, f"{scratch}/none") == "earliest"
    with pytest.raises(ValueError, match="kept_state"):
        start_facts(stream, None, None, f"{scratch}/f", kept_state=f"{scratch}/kept")
