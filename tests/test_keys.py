"""First-seen rows, anti-joins and their plans, hot keys included."""

import random

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from trolley.operators import (
    broadcast_if_small,
    distinct_rows,
    earliest_per_key,
    missing_reference_counts,
    missing_references,
    new_rows,
    recent_keys,
)
from trolley.sinks import write_bucketed


@pytest.fixture(scope="module")
def activity():
    """A third of all rows belong to one key."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(400)}"
        rows.append((key, rng.randrange(50), i, f"payload {i}"))
    return rows


@pytest.fixture
def rows(spark, activity):
    return spark.createDataFrame(activity, "user_id string, at int, seq int, payload string").repartition(4)


def test_earliest_per_key(rows, activity):
    first = {}
    for key, at, seq, payload in sorted(activity, key=lambda r: (r[1], r[2])):
        first.setdefault(key, (key, payload))
    picked = earliest_per_key(rows, "user_id", ["at", "seq"])
    assert picked.columns == ["user_id", "payload"]
    assert sorted(map(tuple, picked.collect())) == sorted(first.values())


def test_earliest_per_key_cuts_before_the_shuffle(rows):
    plan = plan_of(earliest_per_key(rows, "user_id", ["at", "seq"]))
    below_exchange = plan[plan.index("Exchange hashpartitioning(user_id") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_earliest_then_new_needs_one_exchange_of_the_batch(spark, rows):
    stored = spark.range(10).select(F.concat(F.lit("k"), "id").alias("user_id"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = earliest_per_key(rows, "user_id", ["at", "seq"])
        plan = plan_of(new_rows(first, stored, "user_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(user_id") == 2


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_strategies_agree(spark, rows, activity, limit):
    stored = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k1", 3), ("other", 4), (None, 5)], "user_id string, n int"
    )
    expected = sorted(r for r in activity if r[0] not in ("hot", "k1"))
    for strategy in ("direct", "semi_first"):
        got = new_rows(rows, stored, "user_id", strategy=strategy, max_broadcast_bytes=limit)
        assert sorted(map(tuple, got.collect())) == expected


def test_null_key_is_new(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "user_id string, n int")
    stored = spark.createDataFrame([(None,), ("a",)], "user_id string")
    for strategy in ("direct", "semi_first"):
        got = new_rows(rows, stored, "user_id", strategy=strategy)
        assert [r.n for r in got.collect()] == [1]


def test_semi_first_does_not_shuffle_the_stored_table(spark, rows, scratch):
    spark.range(1000).select(F.concat(F.lit("k"), "id").alias("user_id")).write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(new_rows(rows, stored, "user_id", strategy="semi_first", bytes_bound=10))
        over = plan_of(new_rows(rows, stored, "user_id", strategy="semi_first", max_broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    assert "SortMergeJoin" in over and "LeftSemi" not in over


def test_unknown_strategy(rows):
    with pytest.raises(ValueError):
        new_rows(rows, rows, "user_id", strategy="magic")


def test_bucketed_table_is_not_shuffled(spark, rows, scratch):
    stored = spark.range(50).select(F.concat(F.lit("k"), "id").alias("user_id"))
    name = "users_" + scratch[-8:]
    write_bucketed(stored, name, "user_id", 4, path=scratch)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = new_rows(rows, spark.table(name), "user_id")
        plan = plan_of(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    stored_keys = {f"k{i}" for i in range(50)}
    assert got.count() == sum(r.user_id not in stored_keys for r in rows.collect())


def test_distinct_is_partial_first(rows):
    plan = plan_of(distinct_rows(rows.select("user_id", "at")))
    assert plan.count("HashAggregate") == 2


def test_broadcast_only_what_measures_small(spark):
    keys = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert broadcast_if_small(keys, 10) is keys
    assert broadcast_if_small(keys, 1 << 20) is not keys


def test_hot_key_is_split_in_the_anti_join(spark, scratch):
    """With both sides too large to broadcast, AQE splits the partition of the hot key."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    spark.range(60_000).select(hot.alias("user_id"), F.sha2(F.col("id").cast("string"), 512).alias("x")).write.parquet(
        scratch
    )
    facts = spark.read.parquet(scratch)
    dimension = spark.range(0, 60_000, 2).select(F.col("id").cast("string").alias("user_id"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.files.maxPartitionBytes": "200KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        missing = missing_references(facts, dimension, "user_id", max_broadcast_bytes=0)
        n = len(missing.collect())
        plan = plan_of(missing)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "skew=true" in plan
    # Hot rows and odd ids that are no multiple of three are unknown.
    assert n == 20_000 + sum(1 for i in range(60_000) if i % 3 and i % 2)


def test_missing_references_skip_null(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "product_id string")
    known = spark.createDataFrame([("a",)], "product_id string")
    for limit in (0, 1 << 20):
        got = missing_references(facts, known, "product_id", max_broadcast_bytes=limit)
        assert [r.product_id for r in got.collect()] == ["b"]


def test_missing_reference_counts(spark):
    facts = spark.createDataFrame(
        [("a", "x"), ("b", "x"), ("b", "y"), (None, "z"), ("b", None)], "product_id string, category_id string"
    )
    products = spark.createDataFrame([("a",), ("a",)], "product_id string")
    categories = spark.createDataFrame([("x",), ("y",), ("z",)], "category_id string")
    counts = missing_reference_counts(facts, {"product_id": products, "category_id": categories})
    assert sorted(map(tuple, counts.collect())) == [("category_id", 0), ("product_id", 3)]


def test_recent_keys_drop_nothing_that_comes_late(spark, inbox, scratch):
    """Rows received years apart, newest first: the default watermark does not mind."""
    folder, out = f"{scratch}/in", []
    stream = spark.readStream.schema("user_id string, at timestamp").option("maxFilesPerTrigger", 1)
    for day in ("2024-06-01", "2020-01-01", "2016-01-01"):
        spark.sql(f"SELECT 'same' AS user_id, TIMESTAMP '{day}' AS at UNION ALL SELECT '{day}', TIMESTAMP '{day}'").coalesce(
            1
        ).write.mode("append").parquet(folder)
    once = recent_keys(stream.parquet(folder), "user_id", "1 minute")
    query = (
        once.writeStream.foreachBatch(lambda df, _: out.extend(r.user_id for r in df.collect()))
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(out) == ["2016-01-01", "2020-01-01", "2024-06-01", "same"]
