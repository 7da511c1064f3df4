"""Offset coverage against plain Python."""

import random
from collections import Counter

import pytest

from trolley.operators import coverage
from trolley.sinks import OffsetCoverage

MESSAGE = "topic string, partition int, offset long"


def spans_of(counts):
    """Maximal runs of offsets with the same count, from {(topic, partition, offset): n}."""
    spans = []
    for (topic, partition, offset), n in sorted(counts.items()):
        last = spans[-1] if spans else None
        if last and last[:2] == [topic, partition] and last[3] == offset - 1 and last[4] == n:
            last[3] = offset
        else:
            spans.append([topic, partition, offset, offset, n])
    return sorted(map(tuple, spans))


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def offsets():
    rnd = random.Random(8)
    edge = coverage.BLOCK
    made = [("a", 0, o) for o in range(0, 3 * edge + 10) if not 500 <= o < 520 and not edge - 3 <= o < edge + 2]
    made += [("a", 1, rnd.randrange(200)) for _ in range(300)] + [("b", 0, o) for o in (0, edge - 1, edge, 5 * edge, 5 * edge, 2**40)]
    made += [("a", 0, o) for o in range(edge - 20, edge - 3)] * 2
    return made


def test_spans_gaps_and_overlaps(spark, offsets):
    spans = coverage.observed(spark.createDataFrame(offsets, MESSAGE).repartition(4))
    counts = Counter(offsets)
    expected = spans_of(counts)
    assert rows(spans) == expected
    assert rows(coverage.overlaps(spans)) == [span for span in expected if span[4] > 1]
    missing = []
    for before, after in zip(expected, expected[1:]):
        if before[:2] == after[:2] and after[2] > before[3] + 1:
            missing.append((*before[:2], before[3] + 1, after[2] - 1))
    assert rows(coverage.gaps(spans)) == missing
    assert coverage.observed(spark.createDataFrame([], MESSAGE)).count() == 0


def test_batches_add_up_and_count_once(spark, offsets, scratch):
    kept = OffsetCoverage(f"{scratch}/kept")
    assert kept.read(spark).count() == kept.gaps(spark).count() == 0
    shuffled = random.Random(1).sample(offsets, len(offsets))
    for batch, start in enumerate(range(0, len(shuffled), 40_000)):
        part = spark.createDataFrame(shuffled[start : start + 40_000], MESSAGE)
        assert kept.add(part, batch) and not kept.add(part, batch)
    assert rows(kept.read(spark)) == spans_of(Counter(offsets))
    assert kept.read(spark).count() < 400  # spans, not offsets


def test_a_batch_that_dies_before_its_commit_runs_again(spark, scratch, monkeypatch):
    kept = OffsetCoverage(f"{scratch}/kept")
    first, second = ([("t", 0, o) for o in span] for span in (range(10), range(20, 30)))
    kept.add(spark.createDataFrame(first, MESSAGE), 0)
    with monkeypatch.context() as patch:
        patch.setattr("trolley.sinks.files.Commits.publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.add(spark.createDataFrame(second, MESSAGE), 1)
    assert rows(kept.read(spark)) == [("t", 0, 0, 9, 1)]
    assert kept.add(spark.createDataFrame(second, MESSAGE), 1)
    assert rows(kept.gaps(spark)) == [("t", 0, 10, 19)] and rows(kept.overlaps(spark)) == []


def test_records_of_one_message_are_one_offset(spark, scratch):
    decoded = spark.createDataFrame(
        [("t", 0, 1, 0), ("t", 0, 1, 1), ("t", 0, 2, None)],
        "ingest_topic string, ingest_partition int, ingest_offset long, ingest_item int",
    )
    kept = OffsetCoverage(f"{scratch}/kept")
    kept.add_decoded(decoded, 0)
    assert rows(kept.read(spark)) == [("t", 0, 1, 2, 1)]


def test_a_hot_partition_is_combined_before_the_shuffle(spark):
    offsets = spark.range(0, 200_000, 1, 4).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    plan = coverage.observed(offsets)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan[plan.index("Exchange hashpartitioning(topic") :]
    assert rows(coverage.observed(offsets)) == [("t", 0, 0, 199_999, 1)]
