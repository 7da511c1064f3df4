"""Sketches that add up, samples that repeat, types that drift."""

import random

import pytest
from pyspark.sql import functions as F

from trolley.operators import bottom_k
from trolley.operators.drift import drifting, merged_type, record, type_counts
from trolley.operators.sketches import DISTINCT_ERROR, RANK_ERROR, estimates, merged, sketched


def test_sketches_of_batches_add_up(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(5), f"u{rnd.randrange(3000)}", float(int(rnd.expovariate(0.01)))) for _ in range(20_000)]
    frame = spark.createDataFrame(rows, "batch int, user_id string, seconds double").repartition(6)
    batches = sketched(frame, distinct="user_id", measured="seconds", by=["batch"])
    assert batches.count() == 5
    said = estimates(merged(batches), (0.5, 0.95)).first()
    assert said.n_rows == 20_000
    exact = len({user for _, user, _ in rows})
    assert abs(said.n_distinct - exact) <= 4 * DISTINCT_ERROR * exact
    values = sorted(seconds for *_, seconds in rows)
    for q, value in zip((0.5, 0.95), said.quantiles):
        below, upto = (sum(f(v) for v in values) / len(values) for f in (lambda v: v < value, lambda v: v <= value))
        assert below - 2 * RANK_ERROR <= q <= upto + 2 * RANK_ERROR
    assert {r.batch for r in estimates(batches).collect()} == set(range(5))


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(1, None, None)], "batch int, user_id string, seconds double")
    said = estimates(sketched(empty, distinct="user_id", measured="seconds")).first()
    assert (said.n_rows, said.n_distinct, said.quantiles) == (1, 0, None)
    assert merged(sketched(empty.limit(0), distinct="user_id", measured="seconds", by=["batch"]), ["batch"]).count() == 0


def test_a_sample_does_not_depend_on_partitions(spark):
    rows = [(i, "hot" if i % 3 else f"g{i % 5}") for i in range(500)] + [(None, "hot"), (None, None)]
    frame = spark.createDataFrame(rows, "id int, g string")
    picked = [
        sorted(map(repr, bottom_k(frame.repartition(n), 7, ["id"], by=["g"], seed=3).collect())) for n in (1, 2, 9)
    ]
    assert picked[0] == picked[1] == picked[2]
    assert {r.g: r["count"] for r in bottom_k(frame, 7, ["id"], by=["g"]).groupBy("g").count().collect()}["hot"] == 7
    whole = {r.id for r in bottom_k(frame, 20, ["id"]).collect()}
    parts = [bottom_k(frame.where(F.coalesce("id", F.lit(0)) % 2 == i), 20, ["id"]) for i in (0, 1)]
    assert {r.id for r in bottom_k(parts[0].unionByName(parts[1]), 20, ["id"]).collect()} == whole
    assert {r.id for r in bottom_k(frame, 20, ["id"], seed=1).collect()} != whole
    assert bottom_k(frame, 0, ["id"]).count() == bottom_k(frame.limit(0), 3, ["id"], by=["g"]).count() == 0


def test_a_task_ships_few_rows_of_a_hot_group(spark):
    frame = spark.range(1000).selectExpr("id", "concat('g', id % 2) AS g")
    plan = bottom_k(frame, 5, ["id"], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning(g") :]


@pytest.fixture
def records(spark):
    texts = ['{"a":1,"b":{"c":[1,"x",null,{"d":1.5}]}}', '{"a":"1"}', '{"a":null,"new key":true}', "[1]", "7", "not json", None, "{}"]
    return spark.createDataFrame([(t,) for t in texts], "text string").select(record("text").alias("record"))


def test_type_counts(records):
    got = {(r.path, r.type): r.n for r in type_counts(records).collect()}
    assert got == {
        ("$", "OBJECT"): 4, ("$", "ARRAY"): 1, ("$", "BIGINT"): 1, ("$[*]", "BIGINT"): 1,
        ("$.a", "BIGINT"): 1, ("$.a", "STRING"): 1, ("$.a", "VOID"): 1, ("$.new key", "BOOLEAN"): 1,
        ("$.b", "OBJECT"): 1, ("$.b.c", "ARRAY"): 1, ("$.b.c[*]", "BIGINT"): 1, ("$.b.c[*]", "STRING"): 1,
        ("$.b.c[*]", "VOID"): 1, ("$.b.c[*]", "OBJECT"): 1,
    }
    assert {r.path for r in drifting(type_counts(records, depth=1)).collect()} == {"$", "$.a"}
    assert type_counts(records.limit(0)).count() == 0
    assert merged_type(records.where("variant_get(record, '$.a') IS NOT NULL")).first().type.startswith("OBJECT<a: VARIANT")
