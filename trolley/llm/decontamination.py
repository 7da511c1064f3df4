"""Benchmark decontamination: which words of which documents occur in test questions or answers.

Words are runs of ``[0-9a-z]`` and of anything beyond ASCII, after A-Z became a-z. Every item is
cut into windows of ``window`` consecutive words (an item of fewer words is one window). All
windows go into one Aho-Corasick automaton, and each document is scanned once.

Documents without text, or without a word, have ``n_words`` 0 and are not contaminated. Items
without a word match nothing. Rows that repeat are judged row by row; items with the same id
count once. A null ``doc_id`` is passed through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, append, column, fresh, map_batches, narrow

_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_NORMAL = bytes(
    code + 32 if 65 <= code <= 90
    else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128
    else 32
    for code in range(256)
)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
HITS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(SPAN)),
]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


def _spaced(words: list[bytes]) -> str:
    """One character per byte, so that the automaton walks over compact strings; a blank on
    both sides of every word keeps a window from matching inside a word."""
    return b" ".join([b"", *words, b""]).decode("latin-1")


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows with the ids of the items that hold them."""
    rows = items.select(
        items[item_id].cast("string").alias("doc_id"), items[text].cast("string").alias("text")
    ).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, patterns = [], []
            for key, value in zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist()):
                words = words_of(value)
                found = {
                    _spaced(words[at : at + window])
                    for at in range(max(1, len(words) - window + 1))
                } if words else set()
                ids += [key] * len(found)
                patterns += found
            yield pa.record_batch(
                [pa.array(ids, pa.string()), pa.array(patterns, pa.string())], ["doc_id", "window"]
            )

    windows = map_batches(rows, [T.StructField("window", T.StringType())], cut)
    return windows.groupBy("window").agg(F.sort_array(F.collect_set("doc_id")).alias("item_ids"))


class _Scan:
    """Scans batches with one automaton per part of the windows (one part, as a rule).

    ``last`` passes return the result; passes before it return the text with what was hit.
    """

    def __init__(self, parts, part_bytes: int, last: bool):
        self.parts, self.part_bytes, self.last = parts, part_bytes, last
        self.loaded: tuple[int, ahocorasick.Automaton | None] = (-1, None)

    def automaton(self, part: int) -> ahocorasick.Automaton:
        if self.loaded[0] != part:
            self.loaded = (-1, None)
            found = ahocorasick.Automaton()
            for pattern, ids in self.parts[part].value:
                found.add_word(pattern, (pattern.count(" ") - 1, ids))
            found.make_automaton()
            self.loaded = (part, found)
        return self.loaded[1]

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if len(self.parts) == 1 or size >= self.part_bytes:
                yield from self.scanned(waiting)
                waiting, size = [], 0
        yield from self.scanned(waiting)

    def scanned(self, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts outside, texts inside: each part is built once for all waiting batches."""
        found: dict[tuple[int, int], list] = {}
        n_words = [[0] * batch.num_rows for batch in batches]
        for part in range(len(self.parts)):
            scan = self.automaton(part)
            for b, batch in enumerate(batches):
                for i, text in enumerate(column(batch, "text")):
                    words = words_of(text.as_py() or "")
                    n_words[b][i] = len(words)
                    if words and scan.kind == ahocorasick.AHOCORASICK:
                        line = _spaced(words)
                        matches = list(scan.iter(line))
                        if matches:
                            found.setdefault((b, i), []).extend(_by_word(line, matches))
        for b, batch in enumerate(batches):
            texts = column(batch, "text")
            hit, items, spans = [], [], []
            before = column(batch, "spans").to_pylist() if "spans" in batch.schema.names else None
            ids_before = column(batch, "item_ids").to_pylist() if before else None
            for i in range(batch.num_rows):
                matches = found.get((b, i), [])
                if before:
                    matches = matches + [(run["start"], run["end"], ids_before[i]) for run in before[i]]
                n, ids, runs = _merged(matches, n_words[b][i])
                hit.append(n)
                items.append(ids)
                if self.last:
                    runs = _offsets(texts[i].as_py(), runs) if runs else []
                spans.append([{"start": start, "end": end} for start, end in runs])
            arrays = [column(batch, "doc_id")] + ([] if self.last else [texts])
            names = ["doc_id"] + ([] if self.last else ["text"])
            yield pa.record_batch(
                [*arrays, pa.array(n_words[b], pa.int64()), pa.array(hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS)],
                [*names, *(field.name for field in HITS)],
            )


def _by_word(line: str, matches: list) -> list[tuple[int, int, list[str]]]:
    """(first word, end word, items) of matches that end at a blank of ``line``."""
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    ends = np.searchsorted(blanks, [at for at, _ in matches]).tolist()
    return [(end - n, end, ids) for end, (_, (n, ids)) in zip(ends, matches)]


def _merged(found, n_words: int) -> tuple[int, list[str], list[tuple[int, int]]]:
    """Words hit, items, and maximal runs of hit words."""
    if not found:
        return 0, [], []
    change = np.zeros(n_words + 1, np.int64)
    for start, end, _ in found:
        change[start] += 1
        change[end] -= 1
    covered = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(covered)).reshape(-1, 2)
    items = {item for _, _, ids in found for item in ids}
    return int((edges[:, 1] - edges[:, 0]).sum()), sorted(items), [tuple(x) for x in edges.tolist()]


def _offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as code points of the original text."""
    at = [match.span() for match in _WORD.finditer(text)]
    return [(at[first][0], at[end - 1][1]) for first, end in runs]


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    part_bytes: int = 4 << 20,
    group_bytes: int = 256 << 20,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``item_ids`` (of items with occurring
    windows, sorted) and ``spans`` (hit runs, as code points of the original text).

    The windows are measured before anything is broadcast. ``part_bytes`` of them make one
    automaton (some 40 bytes of memory per byte); more than that are scanned part after part by
    the same task, and beyond ``group_bytes`` by one pass over the documents per group.
    """
    rows = narrow(docs, doc_id, text)
    for scan, last in _scans(items, window, item_id, item_text, part_bytes, group_bytes):
        kept = [] if last else [T.StructField("text", T.StringType())]
        rows = map_batches(rows, kept + HITS, scan)
        if not last:
            rows = rows.checkpoint()
    return rows


def _scans(items: DataFrame, window: int, item_id: str, item_text: str, part_bytes: int, group_bytes: int):
    """The passes over the documents, one as a rule, and whether they are the last."""
    spark = items.sparkSession
    windows = item_windows(items, item_id, item_text, window)
    size = windows.agg(
        F.sum(F.octet_length("window") + F.octet_length(F.array_join("item_ids", ",")))
    ).first()[0] or 0
    n_parts = max(1, math.ceil(size / part_bytes))
    per_group = max(1, group_bytes // part_bytes)
    part = F.pmod(F.xxhash64("window"), F.lit(n_parts))

    for first in range(0, n_parts, per_group):
        end = min(first + per_group, n_parts)
        broadcasts = [
            spark.sparkContext.broadcast(
                [tuple(row) for row in windows.where(part == n).toLocalIterator()]
            )
            for n in range(first, end)
        ]
        yield _Scan(broadcasts, 8 * part_bytes, end == n_parts), end == n_parts


def is_contaminated():
    """The contract's rule: a twentieth of the words, and at least one, occur in an item."""
    return _rule("n_hit", "n_words")


def _rule(n_hit: str, n_words: str):
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def clean(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    part_bytes: int = 4 << 20,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns. All windows are
    one group here; a contaminated document is so by all items together."""
    (scan, _), = _scans(items, window, item_id, item_text, part_bytes, 1 << 62)
    n_words, n_hit = (fresh(docs, field.name) for field in HITS[:2])
    return append(docs, HITS[:2], scan, doc_id=doc_id, text=text).where(~_rule(n_hit, n_words)).drop(n_words, n_hit)
