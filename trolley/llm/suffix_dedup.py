"""Suffix-array dedup: bytes that repeat an earlier document are removed, the first copy stays.

A byte goes if it lies in ``width`` consecutive bytes of its document that also start in a
document with a smaller ``doc_id``. Strings are judged on the input. Candidates come from
``repeats``; within a shard, the suffixes of all windows that more than one context holds are
put in order, and the previous and the next suffix with a smaller document in that order give
each its longest earlier match (``longest_previous``). A window is repeated where that match is
``width`` bytes or longer; suffixes are compared that far.

A null text is empty and loses nothing. Rows with equal ``doc_id`` do not remove from each other;
a null ``doc_id`` counts as larger than any other. Removed bytes may split a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trolley.llm.repeats import Block, Contexts, Units, Windows, covered
from trolley.llm.word_hashes import mix


def byte_units(data: np.ndarray, bounds: np.ndarray) -> Units:
    return Units(data, bounds)


def suffix_order(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``width`` bytes, and the length of the
    prefix that each shares with the one before it (up to ``width``)."""
    padded = np.concatenate([data, np.zeros(width + 8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,))
    keys = []
    for at in range(0, width, 8):
        key = words[starts + at].astype(np.uint64)
        if width - at < 8:
            key >>= np.uint64(8 * (8 - (width - at)))
            key <<= np.uint64(8 * (8 - (width - at)))
        keys.append(key)
    order = np.lexsort(keys[::-1])
    shared = np.zeros(len(starts), np.int64)
    open_ = np.ones(max(0, len(starts) - 1), bool)
    for at, key in zip(range(0, width, 8), keys):
        sorted_key = key[order]
        differ = sorted_key[1:] ^ sorted_key[:-1]
        zeros = 8 * np.ones(len(differ), np.int64)
        some = differ != 0
        zeros[some] = (63 - np.floor(np.log2(differ[some].astype(np.longdouble))).astype(np.int64)) // 8
        shared[1:] += np.where(open_, np.minimum(zeros, width - at), 0)
        open_ &= ~some
    return order, shared


def _nearest_smaller(values: np.ndarray, step: int) -> np.ndarray:
    """The nearest place before (step -1) or after (step 1) with a smaller value, or -1.

    All places jump at once over what their target has already jumped over."""
    n = len(values)
    to = np.arange(n) + step
    to[(to < 0) | (to >= n)] = -1
    open_ = np.flatnonzero(to >= 0)
    while len(open_):
        open_ = open_[values[to[open_]] >= values[open_]]
        to[open_] = to[to[open_]]
        open_ = open_[to[open_] >= 0]
    return to


def longest_previous(shared: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in order: whether the longest match with a smaller document reaches
    ``width``, and the smallest document that such matches lead to."""
    run = np.cumsum(shared < width) - 1  # runs of suffixes that share width bytes
    before, after = _nearest_smaller(docs, -1), _nearest_smaller(docs, 1)
    before[(before >= 0) & (run[before] != run)] = -1
    after[(after >= 0) & (run[after] != run)] = -1
    source = np.where(before >= 0, before, after)
    root = np.where(source >= 0, source, np.arange(len(docs)))
    while True:
        up = root[root]
        if (up == root).all():
            return source >= 0, docs[root]
        root = up


def earliest_holders(contexts: Contexts, width: int) -> np.ndarray:
    """The smallest document that holds each window."""
    starts = contexts.window_starts()
    least = np.repeat(contexts.least, contexts.windows)
    hashes = mix(contexts.prefixes.of(starts, starts + width))
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    several = np.zeros(len(starts), bool)
    several[order[1:][same]] = several[order[:-1][same]] = True
    chosen = np.flatnonzero(several)
    if len(chosen):
        order, shared = suffix_order(contexts.units.values, starts[chosen], width)
        _, holder = longest_previous(shared, least[chosen][order], width)
        least[chosen[order]] = holder
    return least


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
KEPT = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(SPAN)),
    T.StructField("kept", T.BinaryType()),
]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _kept(block: Block, mask: np.ndarray) -> list[pa.Array]:
    n_removed, spans, kept = [], [], []
    for lo, hi in zip(block.byte_bounds[:-1], block.byte_bounds[1:]):
        gone = mask[lo:hi]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
        spans.append([{"start": int(a), "end": int(b)} for a, b in edges])
        n_removed.append(int((edges[:, 1] - edges[:, 0]).sum()))
        kept.append(block.data[lo:hi][~gone].tobytes() if len(edges) else block.data[lo:hi].tobytes())
    return [
        pa.array(np.diff(block.byte_bounds)),
        pa.array(n_removed, pa.int64()),
        pa.array(spans, _SPANS),
        pa.array(kept, pa.binary()),
    ]


def dedup_bytes(
    docs: DataFrame, *, width: int = 50, doc_id: str = "doc_id", text: str = "text", **sizes
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs) and the bytes
    ``kept``, one row per row of ``docs``."""
    windows = Windows(width, max(1, width * 16 // 50), byte_units, count_docs=True)
    return covered(docs, windows, earliest_holders, KEPT, _kept, doc_id=doc_id, text=text, **sizes)
