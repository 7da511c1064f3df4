"""Substring dedup by windows of words.

Windows of ``width`` words are dealt out by their anchors (see ``repeats``), as contexts: runs of
windows around an anchor. Within a shard, contexts that are found as a whole become one entry with
the number of their copies; windows of different contexts are compared one by one, by the hash of the
window and of each of its words. No de Bruijn graph is built and the words at the source are not
compared (README says why). Repeated windows go back to the blocks they come from, where a join puts
the runs of neighbouring shards together.

Each word in a repeated window is removed, all copies alike. Null texts have no words. Windows do
not cross documents; rows with equal ``doc_id`` are different documents here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trolley.llm.repeats import Block, Contexts, Units, Windows, covered
from trolley.llm.word_hashes import Prefixes, mix, runs_of

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def word_units(data: np.ndarray, bounds: np.ndarray) -> Units:
    starts, ends, docs = runs_of(~_BLANK[data], bounds)
    values = mix(Prefixes(data).of(starts, ends) + (ends - starts).astype(np.uint64))
    return Units(values, np.searchsorted(docs, np.arange(len(bounds))), starts, ends)


def repeated_edges(contexts: Contexts, width: int) -> np.ndarray:
    """0 for windows that start more than once, -1 for others."""
    starts = contexts.window_starts()
    times = np.repeat(contexts.times, contexts.windows)
    hashes = mix(contexts.prefixes.of(starts, starts + width))
    order = np.argsort(hashes, kind="stable")
    # edges of branching paths: the same hash in several distinct paths, and the same words
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order[1:]] == hashes[order[:-1]]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    at = np.flatnonzero(same)
    first, other = starts[order[head[at]]], starts[order[at]]
    verified = np.ones(len(at), bool)
    for word in range(width):
        verified &= contexts.units.values[first + word] == contexts.units.values[other + word]
    same[at] = verified
    group = np.cumsum(~same) - 1
    total = np.bincount(group, weights=times[order])[group] if len(order) else np.zeros(0)
    found = np.full(len(starts), -1, np.int64)
    found[order[total > 1]] = 0
    return found


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
KEPT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(SPAN)),
    T.StructField("kept", T.StringType()),
]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _kept(block: Block, mask: np.ndarray) -> list[pa.Array]:
    bounds, units, data = block.units.bounds, block.units, block.data.tobytes()
    n_removed, spans, kept = [], [], []
    for doc, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        gone = mask[lo:hi]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
        spans.append([{"start": int(a), "end": int(b)} for a, b in edges])
        n_removed.append(int((edges[:, 1] - edges[:, 0]).sum()))
        stay = np.concatenate([[0], edges.ravel(), [hi - lo]]).reshape(-1, 2)
        parts = [
            data[units.starts[lo + a] : units.ends[lo + b - 1]].split() for a, b in stay if a < b
        ]
        kept.append(b" ".join(word for part in parts for word in part))
    return [
        pa.array(np.diff(bounds)),
        pa.array(n_removed, pa.int64()),
        pa.array(spans, _SPANS),
        pa.array(kept, pa.binary()).cast(pa.string()),
    ]


def dedup_spans(
    docs: DataFrame, *, width: int = 35, doc_id: str = "doc_id", text: str = "text", **sizes
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` (maximal removed runs of words) and the
    words ``kept``, joined by blanks, one row per row of ``docs``."""
    windows = Windows(width, max(1, width * 8 // 35), word_units, count_docs=False)
    return covered(docs, windows, repeated_edges, KEPT, _kept, doc_id=doc_id, text=text, **sizes)
