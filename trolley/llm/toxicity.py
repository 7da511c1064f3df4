"""Toxicity by non-negative positive-unlabelled learning.

Learns from confirmed toxic documents and from unlabelled text, which holds toxic documents too:
with the share ``prior`` of those, the risk of calling unlabelled text clean is corrected for
them, and kept from falling below zero (where a model only fits its sample). The classifier is
linear over the words of a text and their beginnings, by the logarithm of how often they occur,
and over the logarithm of its length, so that a long text needs more evidence.

Labels come only from rows outside the held-out fifth (``crc32(doc_id) mod 5 = 0``). The score
sees the text alone. Unlabelled are all distinct texts of the other rows of those folds: their
document frequencies choose the features, and every step of the fit passes over all of them.
A null or empty text gets the score of a text without any known feature;
without a confirmed example all scores are 0. Repeated rows get the same score each.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, column, map_batches, narrow, saved, small
from trolley.llm.word_hashes import Prefixes, mix, runs_of, slices, text_buffer

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

#: Sums over texts are taken in whole numbers of this size, so that they do not depend on how rows are dealt.
_UNIT = 1 << 24
#: Partial sums of so many tasks come to the driver as they are; those of more are added up by tasks.
_MANY_TASKS = 64
#: Entries that a task passes over in each step of the fit, about.
_ENTRIES = 50_000

#: Bytes of the beginnings of words that are features beside the whole words.
BEGINNINGS = (5, 6, 7, 8)


@dataclass(frozen=True)
class Model:
    """Features by hash in ascending order, their weights with that of the length behind them,
    and the weight of any text."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` texts, with a (row, column, value) for each feature present."""
        z = np.bincount(rows, weights=self.weights[columns] * values, minlength=n) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def features_of(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) pairs, repeated as often as they occur."""
    low = _LOWER[data]
    starts, ends, docs = runs_of(_WORD[low], bounds)
    prefixes = Prefixes(low)
    yield docs, mix(prefixes.of(starts, ends))
    for n in BEGINNINGS:
        long = ends - starts >= n
        hashes = prefixes.of(starts[long], starts[long] + n)
        yield docs[long], mix(hashes + np.uint64(n))


class Lookup:
    """Places of known features. A bitmap sorts out nearly all others before the search."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.bits = np.zeros(1 << 20, bool)
        self.bits[features & np.uint64((1 << 20) - 1)] = True

    def __call__(self, docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.bits[hashes & np.uint64((1 << 20) - 1)])
        docs, hashes = docs[maybe], hashes[maybe]
        at = np.searchsorted(self.features, hashes)
        at[at == len(self.features)] = 0
        known = self.features[at] == hashes if len(self.features) else np.zeros(len(at), bool)
        return docs[known], at[known]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, count) of each feature present, and the words of each text, by text."""
        data, bounds = text_buffer(texts)
        n, width = len(texts), len(self.features) + 1
        n_words = np.zeros(n, np.int64)
        found = [np.zeros(0, np.int64)]
        for first, end in slices(bounds):
            own = bounds[first : end + 1] - bounds[first]
            for part, (docs, hashes) in enumerate(features_of(data[bounds[first] : bounds[end]], own)):
                if part == 0:
                    n_words[first:end] = np.bincount(docs, minlength=end - first)
                docs, places = self(docs, hashes)
                found.append((docs + first) * width + places)
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        keys = np.concatenate([keys, np.arange(1, n + 1) * width - 1])
        order = np.argsort(keys)
        rows, places = np.divmod(keys[order], width)
        return rows, places, np.concatenate([counts, n_words])[order]

    def entries(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, value) of each feature present, and of the length of each text."""
        rows, places, counts = self.counts(texts)
        return rows, places, np.log1p(counts)


def held_out(doc_id: Column | str, folds: int = 5) -> Column:
    text = F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")
    return F.coalesce(F.crc32(text) % folds == 0, F.lit(False))


def _counts(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Feature, and in how many texts of the batch it occurs."""
    for batch in batches:
        data, bounds = text_buffer(column(batch, "text"))
        hashes = [np.zeros(0, np.uint64)]
        for first, end in slices(bounds):
            own = bounds[first : end + 1] - bounds[first]
            pairs = [
                np.stack([docs.astype(np.uint64), found])
                for docs, found in features_of(data[bounds[first] : bounds[end]], own)
            ]
            pairs = np.concatenate(pairs, axis=1)
            pairs = pairs[:, np.lexsort(pairs)]
            new = np.ones(pairs.shape[1], bool)
            new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
            hashes.append(pairs[1, new])
        features, n = np.unique(np.concatenate(hashes), return_counts=True)
        yield pa.record_batch([pa.array(features.view(np.int64)), pa.array(n)], ["doc_id", "in_positive"])


def _packed(rows: np.ndarray, places: np.ndarray, counts: np.ndarray, n: int) -> pa.Array:
    """(place, count) pairs of each text as bytes."""
    pairs = np.stack([places, counts], axis=1).astype(np.uint32)
    bounds = np.searchsorted(rows, np.arange(n + 1)) * 8
    return pa.Array.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(pairs.tobytes())]
    ).cast(pa.binary())


def _unpacked(packed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    packed = packed.cast(pa.large_binary())
    _, offsets, data = packed.buffers()
    bounds = np.frombuffer(offsets, np.int64)[packed.offset : packed.offset + len(packed) + 1]
    pairs = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(np.uint32).reshape(-1, 2)
    return np.repeat(np.arange(len(packed)), np.diff(bounds) // 8), pairs[:, 0], pairs[:, 1]


def _added(parts: RDD) -> np.ndarray:
    """The sum of one array of whole numbers per partition."""
    few = parts.getNumPartitions() <= _MANY_TASKS
    return sum(parts.collect()) if few else parts.treeReduce(np.add)


def _sums(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int, weights: np.ndarray
) -> np.ndarray:
    """Of ``n`` texts, in whole ``1 / _UNIT``: the gradient of the loss of calling them clean, by
    column and for the bias, and that loss."""
    z = np.bincount(rows, weights=weights[:-1][columns] * values, minlength=n) + weights[-1]
    p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    # loss as +1: log(1 + exp(-z)), slope p - 1; loss as -1: log(1 + exp(z)), slope p
    slopes = np.rint(p[rows] * values * _UNIT)
    return np.concatenate(
        [
            np.bincount(columns, weights=slopes, minlength=len(weights) - 1),
            [np.rint(p * _UNIT).sum(), np.rint(np.logaddexp(0, z) * _UNIT).sum()],
        ]
    ).astype(np.int64)


def minimised(
    labelled: tuple[np.ndarray, np.ndarray, np.ndarray],
    n_positive: int,
    unlabelled: Callable[[np.ndarray], np.ndarray],
    n_unlabelled: int,
    n_columns: int,
    prior: float,
    *,
    steps: int = 400,
    rate: float = 0.05,
    decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss (Adam), from
    (text, column, value) of the positive texts and the ``_sums`` of all unlabelled ones."""
    weights, moments, squares = (np.zeros(n_columns + 1) for _ in range(3))
    weights[-1] = np.log(prior / (1 - prior))
    _, columns, values = labelled
    present = np.append(np.bincount(columns, weights=values, minlength=n_columns), n_positive) / n_positive
    for step in range(1, steps + 1):
        positive = _sums(*labelled, n_positive, weights) / (_UNIT * n_positive)
        other = unlabelled(weights) / (_UNIT * n_unlabelled)
        negative_risk = other[-1] - prior * positive[-1]
        gradient = other[:-1] - prior * positive[:-1]
        if negative_risk < 0:
            gradient = -gradient  # only undo the overfit part
        else:
            gradient = gradient + prior * (positive[:-1] - present)
        gradient[:-1] += decay * weights[:-1]
        moments = 0.9 * moments + 0.1 * gradient
        squares = 0.999 * squares + 0.001 * gradient**2
        weights -= rate * (moments / (1 - 0.9**step)) / (
            np.sqrt(squares / (1 - 0.999**step)) + 1e-8
        )
        weights[n_columns - 1] = min(weights[n_columns - 1], 0.0)  # length alone accuses nobody
    return weights[:-1], float(weights[-1])


def fit(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    positive: np.ndarray,
    n_columns: int,
    prior: float,
    **options: float,
) -> tuple[np.ndarray, float]:
    """``minimised`` for texts that are all at hand."""
    place = np.where(positive, np.cumsum(positive), np.cumsum(~positive)) - 1
    own, other = (
        (place[rows[mine]], columns[mine], values[mine]) for mine in (positive[rows], ~positive[rows])
    )
    n_positive, n_other = int(positive.sum()), int((~positive).sum())
    return minimised(
        own, n_positive, lambda w: _sums(*other, n_other, w), n_other, n_columns, prior, **options
    )


def _evidence(in_positive: np.ndarray, in_unlabelled: np.ndarray, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """How many standard errors a feature's share among positives is above that elsewhere."""
    p = in_positive / n_positive
    u = (in_unlabelled + 1) / (n_unlabelled + 1)
    return (p - u) / np.sqrt(u * (1 - np.minimum(u, 0.999)) * (1 / n_positive + 1 / n_unlabelled))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    prior: float | None = None,
    max_positive: int = 4_000,
    n_features: int = 4_096,
    least_share: float = 0.005,
    least_evidence: float = 6.0,
    seed: int = 6,
) -> Model | None:
    """Fit the classifier; None without a confirmed example.

    At most ``max_positive`` labelled documents of the training folds are read as positive, in
    the order of a hash of their id. Everything else of those folds is unlabelled, each distinct
    text once, whatever its number. Only features of enough positive texts can be chosen, so
    that one pass reduces a text to how often those occur; that is all that is shuffled and
    passed over again. ``prior`` defaults to the share of toxic rows among the labels.
    """
    spark = docs.sparkSession
    known = (
        labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("label"))
        .where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = (F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id"))
    rows = (
        narrow(docs, doc_id, text)
        .where(~held_out("doc_id"))
        .withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    )
    if prior is None:
        prior = known.agg(F.avg("label")).first()[0] or 0.0
    if not prior:
        return None
    prior = min(max(prior, 1e-3), 0.5)
    ids = known.where("label = 1").orderBy(*chosen).limit(max_positive).select("doc_id")
    positive = (
        rows.join(F.broadcast(ids), "doc_id", "left_semi")  # at most max_positive ids
        .groupBy("digest")  # copies count once
        .agg(F.first("text").alias("text"))
        .orderBy("digest")
        .limit(max_positive)
        .checkpoint()
    )
    n_positive = positive.count()
    if not n_positive:
        return None
    counted = map_batches(
        positive.select(F.lit(0).cast("long").alias("doc_id"), "text"),
        [T.StructField("in_positive", T.LongType())],
        _counts,
    )
    frequent = (
        counted.groupBy("doc_id")
        .agg(F.sum("in_positive").alias("in_positive"))
        .where(F.col("in_positive") >= max(3, least_share * n_positive))
        .toArrow()  # no more than the features of max_positive texts, divided by the least count
    )
    candidates = frequent.column("doc_id").to_numpy().view(np.uint64)
    order = np.argsort(candidates)
    candidates, in_positive = candidates[order], frequent.column("in_positive").to_numpy()[order]
    if not len(candidates):
        return None
    lookup = spark.sparkContext.broadcast(candidates)

    def reduced(batches: Batches) -> Iterator[pa.RecordBatch]:
        find = Lookup(lookup.value)
        for batch in small(batches, 8 << 20):
            found = _packed(*find.counts(column(batch, "text")), batch.num_rows)
            yield pa.record_batch([column(batch, "doc_id"), found], ["doc_id", "entries"])

    def entries_of(texts: DataFrame) -> DataFrame:
        texts = texts.select(F.col("digest").alias("doc_id"), "text")
        return map_batches(texts, [T.StructField("entries", T.BinaryType())], reduced)

    unlabelled = saved(
        entries_of(rows.join(F.broadcast(positive.select("digest")), "digest", "left_anti"))
        .groupBy("doc_id")
        .agg(F.first("entries").alias("entries"))
        .select("entries"),
        "unlabelled",
    )
    n_candidates = len(candidates)

    def occurring(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_candidates + 1, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(column(batch, "entries"))[1], minlength=n_candidates + 1)
        yield pa.record_batch([pa.array([pickle.dumps(total)])], ["total"])

    totals = unlabelled.mapInArrow(occurring, "total binary").rdd.map(lambda row: pickle.loads(row.total))
    in_unlabelled = _added(totals)
    n_unlabelled = int(in_unlabelled[-1])  # the length of each text
    if not n_unlabelled:
        return None
    evidence = _evidence(in_positive, in_unlabelled[:-1], n_positive, n_unlabelled)
    strong = np.flatnonzero(evidence > least_evidence)
    strong = np.sort(strong[np.lexsort([candidates[strong].view(np.int64), -evidence[strong]])[:n_features]])
    if not len(strong):
        return None
    features, n_columns = candidates[strong], len(strong) + 1
    column_of = np.full(n_candidates + 1, -1)
    column_of[strong] = np.arange(len(strong))
    column_of[-1] = n_columns - 1

    def chosen_of(packed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, places, counts = _unpacked(packed)
        columns = column_of[places]
        own = columns >= 0
        return rows[own], columns[own], counts[own]

    def blocks(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns, counts = chosen_of(column(batch, "entries"))
            found = (np.bincount(rows, minlength=batch.num_rows), columns, counts)
            least = [a.astype(np.min_scalar_type(a.max(initial=0))) for a in found]
            yield pa.record_batch([pa.array([pickle.dumps(least)])], ["block"])

    n_entries = int(in_unlabelled[strong].sum()) + n_unlabelled
    passed = unlabelled.mapInArrow(blocks, "block binary").rdd.map(lambda row: bytes(row.block))
    passed = passed.coalesce(1 + n_entries // _ENTRIES).persist(StorageLevel.MEMORY_AND_DISK)

    def sums(weights: np.ndarray) -> np.ndarray:
        def partial(own: Iterable[bytes]) -> Iterator[np.ndarray]:
            total = np.zeros(len(weights) + 1, np.int64)
            for block in own:
                sizes, columns, counts = pickle.loads(block)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                total += _sums(rows, columns, np.log1p(counts, dtype=np.float64), len(sizes), weights)
            yield total

        return _added(passed.mapPartitions(partial))

    taken = entries_of(positive).orderBy("doc_id").toArrow()  # at most max_positive rows
    own_rows, columns, counts = chosen_of(taken.column("entries").combine_chunks())
    weights, bias = minimised(
        (own_rows, columns, np.log1p(counts, dtype=np.float64)), n_positive, sums, n_unlabelled, n_columns, prior
    )
    passed.unpersist()
    return Model(features, weights, bias)


def score(
    docs: DataFrame, model: Model | None, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1), one row per row of ``docs``."""
    rows = narrow(docs, doc_id, text)
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    known = docs.sparkSession.sparkContext.broadcast(model)  # n_features numbers at most

    def scored(batches: Batches) -> Iterator[pa.RecordBatch]:
        find = Lookup(known.value.features)
        for batch in batches:
            entries = find.entries(column(batch, "text"))
            scores = known.value.scores(*entries, batch.num_rows)
            yield pa.record_batch([column(batch, "doc_id"), pa.array(scores)], ["doc_id", "score"])

    return map_batches(rows, [T.StructField("score", T.DoubleType())], scored)
