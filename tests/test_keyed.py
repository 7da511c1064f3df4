"""Users by key: lookups that read little, late records, folds that may die."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions import bitmaps
from trolley.sinks import KeyedTable, files

SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("city", T.StringType())])
ROW = "user_id string, city string, ingest_ts timestamp, ingest_topic string, ingest_partition int, ingest_offset long, ingest_item int"


def rows_of(spark, rows):
    """(user, city, offset) as rows to be stored."""
    named = spark.createDataFrame(rows, "user_id string, city string, ingest_offset long")
    return named.select(
        "user_id", "city", F.lit(None).cast("timestamp").alias("ingest_ts"), F.lit("t").alias("ingest_topic"),
        F.lit(0).alias("ingest_partition"), "ingest_offset", F.lit(None).cast("int").alias("ingest_item"),
    )


@pytest.fixture
def users(spark, scratch):
    table = KeyedTable(f"{scratch}/users", SCHEMA, bucket_rows=50)
    table.create(spark)
    return table


def held(spark, table):
    return {row.user_id: row.city for row in table.read(spark).collect()}


def test_bitmaps_find_all_keys_and_few_others(spark):
    keys = spark.range(6000).select(F.concat(F.lit("u"), "id").alias("k"))
    known = bitmaps.bitmaps(keys.where("k < 'u5'"), "k", 4, 8).withColumnRenamed("chunk", "c")
    asked = keys.select("k", bitmaps.bucket_of("k", 4).alias("b"), bitmaps.chunk_of("k", 8).alias("c"))
    hits = asked.join(known, (asked.b == known.bucket) & (asked.c == known.c)).where(bitmaps.may_hold(F.col("bits"), "k"))
    found = {row.k for row in hits.select("k").collect()}
    stored = {f"u{i}" for i in range(6000) if f"u{i}" < "u5"}
    assert stored <= found and len(found - stored) < 0.01 * (6000 - len(stored)) + 5
    assert [bitmaps.chunks_for(n) for n in (0, 1, 2048, 2049, 65536)] == [1, 1, 1, 2, 32]


def test_any_order_of_batches_gives_the_earliest_rows(spark, users):
    rnd = random.Random(3)
    rows = [(f"u{rnd.randrange(300)}", f"c{i}", i) for i in range(900)] + [("hot", f"h{i}", 1000 + i) for i in range(400)]
    rnd.shuffle(rows)
    expected = {}
    for user, city, _ in sorted(rows, key=lambda r: -r[2]):
        expected[user] = city
    for start in range(0, len(rows), 260):
        batch = rows_of(spark, rows[start : start + 260])
        users.write(users.improved(batch))
        if start % 520 == 0:
            assert users.fold(spark)
    assert held(spark, users) == expected
    users.fold(spark)
    assert not users.fold(spark)
    assert held(spark, users) == expected
    assert users.improved(rows_of(spark, rows)).count() == 0
    fresh = rows_of(spark, [("u1", "x", 5000), ("new", "y", 1), (None, "z", 2)])
    assert sorted(r.city for r in users.unseen(fresh).collect()) == ["y", "z"]
    assert [r.city for r in users.improved(rows_of(spark, [("hot", "first", -1), ("hot", "last", 9999)])).collect()] == ["first"]
    assert users._state(spark).buckets >= 4 and users.stored(spark, "user_id").count() == len(expected)


def test_a_fold_writes_only_the_buckets_that_get_rows(spark, users):
    users.write(rows_of(spark, [(f"u{i}", "a", i) for i in range(300)]))
    users.fold(spark)
    before = users._state(spark)
    users.write(rows_of(spark, [("u7", "earlier", -1)]))
    users.fold(spark)
    after = users._state(spark)
    assert after.buckets == before.buckets and sum(a != b for a, b in zip(before.versions, after.versions)) == 1
    assert held(spark, users)["u7"] == "earlier" and sum(after.counts) == 300


@pytest.mark.parametrize("step", ["rows", "published"])
def test_a_fold_that_dies_changes_nothing(spark, users, monkeypatch, step):
    users.write(rows_of(spark, [(f"u{i}", "a", i) for i in range(100)]))
    users.fold(spark)
    users.write(rows_of(spark, [("u3", "earlier", -5), ("u100", "new", 1)]))
    expected = {**{f"u{i}": "a" for i in range(100)}, "u3": "earlier", "u100": "new"}

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if step == "rows":
            patch.setattr(KeyedTable, "_publish", dies)
        else:
            patch.setattr("trolley.sinks.keyed.remove", dies)
        with pytest.raises(RuntimeError):
            users.fold(spark)
    assert held(spark, users) == expected
    assert users.unseen(rows_of(spark, [("u100", "x", 9), ("u5", "x", 9)])).count() == 0
    users.fold(spark)
    assert held(spark, users) == expected


def test_rows_may_be_added_twice_and_need_a_key(spark, users):
    batch = rows_of(spark, [("a", "x", 1), ("b", "y", 2)])
    users.write(batch)
    users.write(batch)
    users.fold(spark)
    users.write(batch)
    assert held(spark, users) == {"a": "x", "b": "y"}
    with pytest.raises(Exception, match="user_id is null"):
        users.write(rows_of(spark, [(None, "z", 3)]))


def test_folds_are_due_by_rows_or_by_files(spark, users):
    few = KeyedTable(users.path, SCHEMA, fold_rows=3)
    assert not few.due(spark)
    users.write(rows_of(spark, [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)]))
    assert few.due(spark) and not users.due(spark)
    assert KeyedTable(users.path, SCHEMA, fold_files=1).due(spark)
    users.fold(spark)
    assert not few.due(spark)


def test_a_fold_shuffles_rows_of_buckets_once(spark, users):
    users.write(rows_of(spark, [(f"u{i}", "a", i) for i in range(100)]))
    users.fold(spark)
    state = users._state(spark)
    old = users._bucketed(spark, state, range(state.buckets))
    bucket = bitmaps.bucket_of("user_id", state.buckets).alias("bucket")
    first = Window.partitionBy("bucket", "user_id").orderBy(*users.order)
    dealt = old.select("*", bucket).repartition("bucket").withColumn("_rank", F.row_number().over(first))
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_files_that_no_fold_needs_are_removed(spark, users):
    for n in range(4):
        users.write(rows_of(spark, [(f"v{n}-{i}", "a", i) for i in range(40)]))
        users.fold(spark)
    state = users._state(spark)
    named = {(kind, v, b) for kind in ("rows", "bitmaps") for b, v in enumerate(state.versions) if v >= 0}
    for kind, version, bucket in named:
        assert files.exists(spark, f"{users.path}/{kind}/{version}/bucket={bucket}")
    assert not [name for name in files.children(spark, f"{users.path}/rows/1") if name.startswith("bucket=")]
    assert not [name for name in files.children(spark, f"{users.path}/added") if name.startswith("part-")]


def bytes_read(spark, table, keys):
    """Size of all files that a lookup opens."""
    state = table._state(spark)
    hits = table._hits(spark, state, keys)
    buckets = {r.b for r in keys.select(bitmaps.bucket_of("user_id", state.buckets).alias("b")).collect()}
    paths = table._paths(state, "rows", hits) + table._paths(state, "bitmaps", buckets)
    return len(hits), sum(n for path in paths for name, n in files.children(spark, path).items() if name.startswith("part-"))


def test_a_lookup_reads_as_much_from_a_large_table_as_from_a_small_one(spark, scratch):
    old = spark.createDataFrame([(f"u{i}",) for i in range(5)], "user_id string")
    read = []
    for n in (2_000, 16_000):
        table = KeyedTable(f"{scratch}/users{n}", SCHEMA, bucket_rows=250)
        table.create(spark)
        ids = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"), F.lit("c").alias("city"), F.col("id").alias("o"))
        layout = [F.lit(None).cast("timestamp").alias("ingest_ts"), F.lit("t").alias("ingest_topic"),
                  F.lit(0).alias("ingest_partition"), F.col("o").alias("ingest_offset"), F.lit(None).cast("int").alias("ingest_item")]
        table.write(ids.select("user_id", "city", *layout))
        table.fold(spark)
        assert table.found(spark, old).count() == 5
        read.append(bytes_read(spark, table, old))
    (few, small), (more, large) = read
    assert few <= 5 and more <= 5 and large / more < 1.5 * small / few
    plan = table.found(spark, old)._jdf.queryExecution().executedPlan().toString()
    state = table._state(spark)
    assert sum(f"bucket={b}]" in plan or f"bucket={b}," in plan for b in range(state.buckets)) <= 5
