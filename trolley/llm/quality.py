"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (documents labelled good) and one
of all raw text, give every document an importance: the log ratio of its probabilities. Gumbel
noise on that and the largest ``k`` keys are a sample of ``k`` documents without replacement. ``k``
is a share of all rows if ``keep`` is given, else the number of documents that labelled examples
say are worth keeping. Importances are sums over a whole text, which differ by far more than the
noise: the sample is nearly that of the ``k`` most important documents, whatever the seed.

N-grams are those of words (1 and 2) and of the shapes of words (1 to 3): letter case, digits,
punctuation, repetition. A document without a word has importance 0. Documents whose keys equal
the smallest selected one, such as repeated rows, are all selected. Without labelled good
documents nothing can be told apart, and every document is selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, append, column, fresh, map_batches, narrow, saved
from trolley.llm.word_hashes import Prefixes, mix, runs_of, slices, text_buffer

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_PUNCT = (_CODES > 32) & (_CODES < 127) & ~_UPPER & ~_DIGIT & ~((_CODES >= 97) & (_CODES <= 122))

#: Orders of the n-grams of words, and of the shapes of words; each family has its own buckets.
WORD_ORDERS, SHAPE_ORDERS = (1, 2), (1, 2, 3)


@dataclass(frozen=True)
class Ratio:
    """Log ratio of target and raw probability by bucket, and the least importance to keep."""

    logs: np.ndarray
    threshold: float


def _summed(mask: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(mask[data], out=sums[1:])
    return sums[ends] - sums[starts]


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    upper = np.minimum(_summed(_UPPER, data, starts, ends), 2)
    punct = np.minimum(_summed(_PUNCT, data, starts, ends), 3)
    digit = np.minimum(_summed(_DIGIT, data, starts, ends), 1)
    only = ends - starts == punct
    last = np.where(_PUNCT[data[ends - 1]], data[ends - 1], 0)
    again = np.zeros(len(words), np.int64)
    again[1:] = (words[1:] == words[:-1]) & (docs[1:] == docs[:-1])
    code = ((((upper * 4 + punct) * 2 + digit) * 2 + only) * 2 + again) * 256 + last
    return mix(code.astype(np.uint64) + np.uint64(1))


def ngram_buckets(data: np.ndarray, bounds: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram; family ``f`` has the buckets from ``f * buckets``."""
    starts, ends, docs = runs_of(~_BLANK[data], bounds)
    words = mix(Prefixes(_LOWER[data]).of(starts, ends))
    shapes = _shapes(data, starts, ends, words, docs)
    family = 0
    for units, orders in ((words, WORD_ORDERS), (shapes, SHAPE_ORDERS)):
        for order in orders:
            if len(units) >= order:
                n = len(units) - order + 1
                together = docs[:n] == docs[order - 1 :]
                hashes = units[:n].copy()
                for i in range(1, order):
                    hashes = mix(hashes + np.uint64(i)) + units[i : n + i]
                places = (mix(hashes) % np.uint64(buckets)).astype(np.int64) + family * buckets
                yield docs[:n][together], places[together]
            family += 1


N_FAMILIES = len(WORD_ORDERS) + len(SHAPE_ORDERS)


def _parts(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, bounds = text_buffer(texts)
    for first, end in slices(bounds):
        own = bounds[first : end + 1] - bounds[first]
        for docs, places in ngram_buckets(data[bounds[first] : bounds[end]], own, buckets):
            yield docs + first, places


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in ``rows``: one row per task and bucket is shuffled."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_FAMILIES * buckets, np.int64)
        for batch in batches:
            for _, places in _parts(column(batch, "text"), buckets):
                total += np.bincount(places, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], ["doc_id", "n"])

    keyed = rows.select(F.lit(0).cast("long").alias("doc_id"), "text")
    counted = map_batches(keyed, [T.StructField("n", T.LongType())], count)
    total = np.zeros(N_FAMILIES * buckets, np.int64)
    for place, n in counted.groupBy("doc_id").agg(F.sum("n")).collect():
        total[place] = n
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray, buckets: int, smoothing: float = 1.0) -> np.ndarray:
    """Of the two smoothed multinomial models, family by family."""

    def logs(counts: np.ndarray) -> np.ndarray:
        families = counts.reshape(N_FAMILIES, buckets) + smoothing
        return np.log(families / families.sum(axis=1, keepdims=True)).ravel()

    return logs(target) - logs(raw)


WEIGHT = T.StructField("log_weight", T.DoubleType())


def _weigher(spark: SparkSession, logs: np.ndarray, buckets: int):
    known = spark.sparkContext.broadcast(logs)  # N_FAMILIES * buckets numbers

    def weigh(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            for docs, places in _parts(column(batch, "text"), buckets):
                if len(docs):
                    part = np.bincount(docs - docs[0], weights=known.value[places])
                    weights[docs[0] : docs[0] + len(part)] += part
            yield pa.record_batch([column(batch, "doc_id"), pa.array(weights)], ["doc_id", "log_weight"])

    return weigh


def importances(rows: DataFrame, logs: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id`` and ``log_weight`` of (doc_id, text) rows."""
    return map_batches(rows, [WEIGHT], _weigher(rows.sparkSession, logs, buckets))


def best_threshold(weights: np.ndarray, good: np.ndarray, cost: float) -> float:
    """The cut, 0 at most, with the least cost on labelled documents, a lost good document
    counting ``cost`` times as much as a bad one that stays."""
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(good)]) * cost
    kept = np.concatenate([[0], np.cumsum(~good)])
    losses = lost + (kept[-1] - kept)
    cuts = np.concatenate([[-np.inf], (weights[:-1] + weights[1:]) / 2, [np.inf]])
    allowed = cuts <= 0
    return float(cuts[allowed][np.argmin(losses[allowed])])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    buckets: int = 1 << 13,
    max_labelled: int = 20_000,
    cost: float = 3.0,
    seed: int = 9,
) -> Ratio | None:
    """The log ratio from all raw text and from the labelled documents, of which
    ``max_labelled`` at most are read, in the order of a hash of their id."""
    known = (
        labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(max_labelled)
    )
    rows = narrow(docs, doc_id, text)
    sample = rows.join(F.broadcast(known), "doc_id").checkpoint()  # max_labelled ids at most
    target = bucket_counts(sample.where("label = 1"), buckets)
    if not target.any():
        return None
    logs = log_ratio(target, bucket_counts(rows, buckets), buckets)
    scored = _labelled_importances(sample, logs, buckets)
    return Ratio(logs, best_threshold(scored[0], scored[1], cost))


def _labelled_importances(sample: DataFrame, logs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Importance and label of the labelled sample."""
    keyed = sample.select((F.col("label") == 1).alias("doc_id"), "text")
    table = importances(keyed, logs, buckets).toArrow()
    return table.column("log_weight").to_numpy(), table.column("doc_id").to_numpy().astype(bool)


def gumbel(doc_id: Column | str, seed: int) -> Column:
    """Noise that a document keeps however often it is drawn."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, name: str, k: int, width: int = 4096) -> float:
    """The k-th largest value of a column, by counts over ever smaller ranges: the driver sees
    ``width`` rows per round and no round moves a value."""
    low, high = keys.agg(F.min(name), F.max(name)).first()
    while low < high:
        step = (high - low) / width
        if low + step == low:
            break
        place = F.least(F.floor((F.col(name) - low) / step), F.lit(width - 1))
        counts = dict(
            keys.where(F.col(name).between(low, high)).groupBy(place.alias("place")).agg(F.count("*")).collect()
        )
        above = k
        for at in sorted(counts, reverse=True):
            if above <= counts[at]:
                break
            above -= counts[at]
        inside = keys.where(F.col(name).between(low, high) & (place == at))
        low, high = inside.agg(F.min(name), F.max(name)).first()
        k = above
    return low


def resample(
    docs: DataFrame,
    ratio: Ratio | None,
    *,
    keep: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = 1 << 13,
    temperature: float = 0.1,
    seed: int = 9,
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``key`` and ``selected``, one row per row of ``docs``.

    ``key = log_weight / temperature + noise``: below 1, the temperature sharpens the sample.
    """
    rows = narrow(docs, doc_id, text)
    if ratio is None:
        weighed = rows.select("doc_id", F.lit(0.0).alias("log_weight"))
    else:
        weighed = importances(rows, ratio.logs, buckets)
    keyed = weighed.withColumn("key", _key("log_weight", "doc_id", temperature, seed)).checkpoint()
    cut = _cut(keyed, "log_weight", "key", ratio, keep)
    return keyed.withColumn("selected", F.col("key") >= cut)


def _key(weight: str, doc_id: str, temperature: float, seed: int) -> Column:
    return F.col(weight) / temperature + gumbel(doc_id, seed)


def _cut(keyed: DataFrame, weight: str, key: str, ratio: Ratio | None, keep: float | None) -> float:
    """The smallest key that is selected."""
    least = -float("inf") if ratio is None else ratio.threshold
    n, worthy = keyed.agg(F.count("*"), F.count_if(F.col(weight) >= least)).first()
    k = round(keep * n) if keep is not None else worthy
    return kth_largest(keyed, key, k) if k else float("inf")


def selected(
    docs: DataFrame,
    ratio: Ratio | None,
    *,
    keep: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    buckets: int = 1 << 13,
    temperature: float = 0.1,
    seed: int = 9,
) -> DataFrame:
    """The rows of ``docs`` that ``resample`` selects, with their own columns."""
    if ratio is None:
        return docs
    weight, key = fresh(docs, "log_weight"), fresh(docs, "key")
    weigh = _weigher(docs.sparkSession, ratio.logs, buckets)
    weighed = append(docs, [WEIGHT], weigh, doc_id=doc_id, text=text)
    keyed = saved(weighed.withColumn(key, _key(weight, doc_id, temperature, seed)), "weighed")
    return keyed.where(F.col(key) >= _cut(keyed, weight, key, ratio, keep)).drop(weight, key)
