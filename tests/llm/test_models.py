"""Operators 6 and 9: held-out quality, edge cases and exact selection."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.llm import quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def area(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    n = labels.sum()
    return (ranks[labels].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_toxicity_on_held_out_documents(spark):
    found = queries.op6_toxicity(spark, "/root/testdata/sf0.1")
    labels = queries.read(spark, "/root/testdata/sf0.1", "labels")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    toxic = np.array([r.toxic == 1 for r in rows])
    assert area(np.array([r.score for r in rows]), toxic) > 0.95
    caught = np.mean([r.predicted == r.toxic for r in rows if r.toxic])
    assert caught > 0.85 and np.mean([r.predicted for r in rows if not r.toxic]) < 0.06


def test_toxicity_edges(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    labels = spark.createDataFrame([(i, int(i < 4)) for i in range(1, 20)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = toxicity.score(docs, model).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.train(nothing, labels) is None


def test_toxicity_sees_all_unlabelled_text(spark):
    ids = spark.range(16_000).where(~toxicity.held_out("id"))
    ids = [r.id for r in ids.orderBy(F.xxhash64("id", F.lit(6)), "id").collect()]
    rare = ids[9_000:]  # what a sample of the first thousands by hash does not see
    toxic = ids[:9_000:30]
    texts = {i: f"plain text {i % 97}" for i in ids} | {i: f"berry text {i % 97}" for i in rare}
    texts |= {i: f"venom {'berry' if n % 3 == 0 else 'plain'} text {i % 97}" for n, i in enumerate(toxic)}
    docs = spark.createDataFrame([(i, f"{text} {i}") for i, text in texts.items()], "doc_id long, text string")
    labels = [(i, 1) for i in toxic] + [(i, 0) for i in ids[1:9_000:3]]
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    known = set(model.features.tolist())
    (word, berry), (_, venom) = (
        next(toxicity.features_of(*toxicity.text_buffer(toxicity.pa.array([text])))) for text in ("berry", "venom")
    )
    assert len(word) == 1 and int(venom[0]) in known and int(berry[0]) not in known
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert max(scores[i] for i in rare) < 0.5 < min(scores[i] for i in toxic)


def test_non_negative_risk_learns_the_positive_feature():
    rng = np.random.default_rng(1)
    positive = np.arange(600) < 200
    hidden = rng.random(600) < 0.2  # toxic documents among the unlabelled
    toxic = positive | hidden
    rows, columns = np.nonzero(np.stack([toxic, rng.random(600) < 0.5], axis=1))
    weights, bias = toxicity.fit(rows, columns, np.ones(len(rows)), positive, 2, 0.2)
    assert weights[0] + bias > 0 > bias and abs(weights[1]) < weights[0] / 3


def test_quality_rejects_what_labels_call_bad(spark):
    found = queries.op9_quality(spark, SF_DIR).join(queries.read(spark, SF_DIR, "labels"), "doc_id").collect()
    good = [r.selected for r in found if r.quality == 1]
    bad = [r.selected for r in found if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_quality_edges(spark, docs, rows, nothing):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality.fit(docs, none) is None
    assert quality.selected(docs, None).count() == len(rows)
    labels = spark.createDataFrame([(i, int(i != 14)) for i in range(1, 20)], "doc_id long, quality int")
    ratio = quality.fit(docs, labels)
    result = quality.resample(docs, ratio)
    assert result.count() == len(rows)
    kept = quality.selected(docs, ratio)
    assert kept.schema == docs.schema
    assert kept.count() == result.where("selected").count()
    assert quality.resample(nothing, ratio).count() == 0
    assert quality.fit(nothing, labels) is None


@pytest.mark.parametrize("k", [1, 2, 17, 499, 500])
def test_kth_largest(spark, k):
    values = [float(v) for v in np.random.default_rng(k).normal(size=300)] + [0.5] * 199 + [1e12]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    assert quality.kth_largest(keys, "key", k, width=8) == sorted(values, reverse=True)[k - 1]


def test_gumbel_sample_follows_the_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("double").alias("w"))
    keyed = docs.withColumn("key", F.col("w") * 2 + quality.gumbel("doc_id", 3))
    cut = quality.kth_largest(keyed, "key", 400)
    share = keyed.where(F.col("key") >= cut).agg(F.avg("w")).first()[0]
    assert 0.82 < share < 0.94  # e^2 to 1
