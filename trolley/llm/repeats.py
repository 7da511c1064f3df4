"""Windows of units that occur more than once in a corpus, found exactly and without pairs.

A unit is a byte or a word, a window ``width`` consecutive units of one document. Each window
is represented by its anchor, the run of ``gram`` units in it with the smallest hash (the
leftmost of equals); consecutive windows with one anchor form a context, a piece of text of less
than ``2 * width`` units. Equal windows have equal anchors. So:

1. Documents are packed into blocks of some MB, the rows of all later steps.
2. Each block names its distinct anchors by shard; shards answer which of them occur again.
3. Blocks outline the distinct contexts of those anchors to shards: the hash of the whole, and the
   hashes of the anchor with half of what a window has besides, to its left and to its right. Each
   window around the anchor holds one of these halves. So a context of which no half occurs in
   a different context has its windows in equal contexts alone, and the shard can answer for it.
4. Blocks send the other contexts to shards, with their text. Shards compare the windows
   themselves (how, is up to the operator) and answer which are repeated.
5. Blocks cover their contexts, every occurrence of them, as answered.

What one block sends of an anchor or a context is one entry however often it occurs there. An
anchor found in more than ``hot_blocks`` blocks sends its windows one by one, each to the shard
of its own hash, so that a passage of all documents does not meet in one task.

Blocks are kept in buckets by number, so that no step shuffles them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, bucketed, column, map_batches, narrow, saved
from trolley.llm.word_hashes import Prefixes, mix, slices, text_buffer

LAST_ID = (1 << 63) - 1


def _compress(data: np.ndarray) -> bytes:
    """Texts move and rest compressed, better than the shuffle's codec does it."""
    return pa.compress(data.tobytes(), codec="zstd", asbytes=True)


def _decompress(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)


def _columns(*columns: np.ndarray) -> bytes:
    """Columns of numbers, as long as each other, by place of the byte: high ones are often equal."""
    return _compress(np.concatenate([x.view(np.uint8).reshape(len(x), -1).T.ravel() for x in columns]))


def _rows_of(data: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    """The ``n`` rows of columns of ``kinds`` that ``_columns`` has written."""
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    flat = np.frombuffer(_decompress(data, n * sum(sizes)), np.uint8)
    parts = np.split(flat, np.cumsum([n * size for size in sizes])[:-1])
    return [np.ascontiguousarray(x.reshape(-1, n).T).view(kind).ravel() for x, kind in zip(parts, kinds)]


@dataclass(frozen=True)
class Units:
    """Texts of a block as units: their values, and the bytes they lie at."""

    values: np.ndarray
    bounds: np.ndarray  # of texts, in units
    starts: np.ndarray | None = None  # of units, in bytes; None if units are bytes
    ends: np.ndarray | None = None

    def byte_range(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            return lo, hi
        return self.starts[lo], self.ends[hi - 1]


@dataclass(frozen=True)
class Windows:
    """What to look for. ``cut`` makes units of texts; ``count_docs`` tells whether only
    windows of different documents are repeats."""

    width: int
    gram: int
    cut: Callable[[np.ndarray, np.ndarray], Units]
    count_docs: bool


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + counts[0] - 1, starts[1] .. and so on."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + counts, counts)


BLOCK = [
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("bounds", T.ArrayType(T.LongType())),
    T.StructField("text", T.BinaryType()),
]


def packed(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> DataFrame:
    """Blocks of whole documents, as a table of their own: ``doc_id`` is the block's number."""
    rows = narrow(docs, doc_id, text)
    keyed = rows.select(F.lit(0).cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("id"), "text")

    def pack(batches: Batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = text_buffer(column(batch, "text"))
            ids = column(batch, "id")
            for first, end in slices(bounds, block_bytes):
                own = bounds[first : end + 1] - bounds[first]
                part = _compress(data[bounds[first] : bounds[end]])
                lists = [pa.array([x], pa.list_(pa.int64())) for x in (ids[first:end].to_pylist(), own.tolist())]
                yield pa.record_batch(
                    [pa.array([number]), *lists, pa.array([part], pa.binary())],
                    ["doc_id", *(field.name for field in BLOCK)],
                )
                number += 1

    return bucketed(map_batches(keyed, BLOCK, pack), "blocks")


class Block:
    """A block in memory, with its windows and contexts."""

    def __init__(self, row: dict, windows: Windows):
        self.number, self.windows = row["doc_id"], windows
        self.ids = np.array([LAST_ID if x is None else x for x in row["ids"]], np.int64)
        self.raw_ids = row["ids"]
        self.byte_bounds = np.array(row["bounds"], np.int64)
        self.data = np.frombuffer(_decompress(row["text"], int(self.byte_bounds[-1])), np.uint8)
        self.units = windows.cut(self.data, self.byte_bounds)
        sizes = np.diff(self.units.bounds)
        self.docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), sizes)
        self.prefixes = Prefixes(self.units.values)
        self.starts = ranges(self.units.bounds[:-1], np.maximum(0, sizes - windows.width + 1))

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor key, first and last window start, and place of the anchor of each context."""
        if not len(self.starts):
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        gram, reach = self.windows.gram, self.windows.width - self.windows.gram + 1
        hashes = mix(self.prefixes.of_all(gram))
        least = hashes >> np.uint64(32) << np.uint64(32)
        least |= np.arange(len(least), dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < reach:
            least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
        anchors = (least[self.starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(anchors), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchors)) - 1
        return hashes[anchors[first]], self.starts[first], self.starts[last], anchors[first]

    def keys(self, n_shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
        """Distinct keys by shard, the place of each context's key among them, and contexts."""
        found = self.contexts()
        shards = (found[0] >> np.uint64(32)) % np.uint64(n_shards)
        wide = shards << np.uint64(32) | found[0] & np.uint64(0xFFFFFFFF)
        distinct, place = np.unique(wide, return_inverse=True)
        return distinct, place, shards.astype(np.int64), found


def _blocks(batches: Batches, windows: Windows) -> Iterator[tuple[Block, dict]]:
    """Blocks and their rows, one at a time: each is emptied before the next one is made."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = Block(row, windows)
            yield block, row
            block.__dict__.clear()
            row.clear()
            pa.default_memory_pool().release_unused()


def _named(batches: Batches, windows: Windows, n_shards: int) -> Iterator[pa.RecordBatch]:
    """Step 2, blocks: distinct keys by shard; those repeated within the block are marked."""
    for block, _ in _blocks(batches, windows):
        distinct, place, _, found = block.keys(n_shards)
        if windows.count_docs:
            docs = block.docs[found[1]]
            low, high = np.full(len(distinct), len(block.ids)), np.full(len(distinct), -1)
            np.minimum.at(low, place, docs)
            np.maximum.at(high, place, docs)
            again = low < high
        else:
            again = np.bincount(place, minlength=len(distinct)) > 1
        shards = (distinct >> np.uint64(32)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        parts = np.split(distinct.astype(np.uint32), cuts)
        marks = np.split(again, cuts)
        if len(distinct):
            yield pa.record_batch(
                [
                    pa.array([block.number] * len(parts), pa.int64()),
                    pa.array(shards[np.concatenate([[0], cuts])]),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                    pa.array([np.packbits(x).tobytes() for x in marks], pa.binary()),
                ],
                ["doc_id", "shard", "keys", "again"],
            )


_MASKS = "doc_id long, shard int, mask binary, hot binary"


def _repeated(hot_blocks: int):
    """Step 2, shards: which of each block's keys occur again, and which very often."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        again = [
            np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool)
            for x, k in zip(table.column("again").to_pylist(), keys)
        ]
        distinct, place, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        marked = np.zeros(len(distinct), bool)
        marked[place[np.concatenate(again)]] = True
        bounds = np.cumsum([len(k) for k in keys])[:-1]
        masks = np.split((marked | (counts > 1))[place], bounds)
        hot = np.split((counts > hot_blocks)[place], bounds)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "shard": table.column("shard"),
                "mask": _bits(masks),
                "hot": _bits(hot),
            }
        ).filter(pc.field("mask").is_valid())

    return answer


def _bits(masks: list[np.ndarray]) -> pa.Array:
    return pa.array([np.packbits(x).tobytes() if x.any() else None for x in masks], pa.binary())


def _filled(mask: np.ndarray, starts: np.ndarray, replies: list[dict] | None, name: str) -> np.ndarray:
    """``mask`` with what shards have answered; that of each shard begins at one of ``starts``."""
    for reply in replies or ():
        lo, hi = starts[reply["shard"]], starts[reply["shard"] + 1]
        if reply[name] is not None:
            mask[lo:hi] = np.unpackbits(np.frombuffer(reply[name], np.uint8), count=hi - lo)
    return mask


@dataclass
class Entries:
    """The distinct contexts of a block whose anchors are repeated, by shard."""

    lo: np.ndarray
    hi: np.ndarray
    hashes: np.ndarray
    left: np.ndarray  # hashes of the halves
    right: np.ndarray
    least: np.ndarray  # smallest and largest document that holds the context
    most: np.ndarray
    times: np.ndarray
    part: np.ndarray  # of the shard, where texts are compared
    bounds: np.ndarray  # of shards
    found_lo: np.ndarray  # of all occurrences, those of one context after another
    found_hi: np.ndarray
    found_id: np.ndarray  # the document of each

    def shards(self) -> list[tuple[int, int, int]]:
        """Each shard that has entries, its first and its end."""
        some = np.flatnonzero(np.diff(self.bounds))
        return list(zip(some.tolist(), self.bounds[some].tolist(), self.bounds[some + 1].tolist()))


def _entries(block: Block, row: dict, n_shards: int, n_parts: int) -> Entries:
    windows, prefixes = block.windows, block.prefixes
    width, gram = windows.width, windows.gram
    distinct, place, shards, (keys, first, last, anchors) = block.keys(n_shards)
    starts = np.searchsorted(distinct >> np.uint64(32), np.arange(n_shards + 1))
    repeated, hot = (_filled(np.zeros(len(distinct), bool), starts, row["replies"], x) for x in ("mask", "hot"))
    single = (repeated & hot)[place]
    whole = (repeated & ~hot)[place]
    one = ranges(first[single], last[single] - first[single] + 1)
    lo = np.concatenate([first[whole], one])
    hi = np.concatenate([last[whole], one]) + width
    hashes = mix(prefixes.of(lo, hi) + (hi - lo).astype(np.uint64))
    # a half that the context does not hold is found in equal contexts alone
    half, middle = (width - gram + 1) // 2, anchors[whole]
    left, right = hashes.astype(np.uint32), hashes.astype(np.uint32)
    has = np.flatnonzero(lo[: len(middle)] <= middle - half)
    left[has] = mix(prefixes.of(middle[has] - half, middle[has] + gram))
    has = np.flatnonzero(hi[: len(middle)] >= middle + gram + half)
    right[has] = mix(prefixes.of(middle[has], middle[has] + gram + half))
    to = np.concatenate([shards[whole], (hashes[len(middle) :] % np.uint64(n_shards)).astype(np.int64)])
    part = np.zeros(len(lo), np.int64)
    part[: len(middle)] = keys[whole] % np.uint64(n_parts)
    order = np.lexsort((lo, hashes, to))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    heads = np.flatnonzero(new)
    ids, chosen = block.ids[block.docs[lo]][order], order[heads]
    return Entries(
        *(x[chosen] for x in (lo, hi, hashes, left, right)),
        np.minimum.reduceat(ids, heads) if len(heads) else ids,
        np.maximum.reduceat(ids, heads) if len(heads) else ids,
        np.diff(np.append(heads, len(order))),
        part[chosen],
        np.searchsorted(to[chosen], np.arange(n_shards + 1)),
        lo[order],
        hi[order],
        ids,
    )


_OUTLINES = [
    T.StructField("shard", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("outlines", T.BinaryType()),
]
_OUTLINE = (np.uint64, np.uint32, np.uint32, np.int64)


def _outlined(batches: Batches, windows: Windows, n_shards: int, n_parts: int) -> Iterator[pa.RecordBatch]:
    """Step 3, blocks: hashes of contexts and of their halves, and the smallest document that
    holds them, or how often they occur."""
    for block, row in _blocks(batches, windows):
        found = _entries(block, row, n_shards, n_parts)
        value = found.least if windows.count_docs else found.times
        rows = found.shards()
        if rows:
            steps = np.diff(found.hashes, prepend=np.uint64(0))
            steps[found.bounds[:-1][np.diff(found.bounds) > 0]] = found.hashes[[a for _, a, _ in rows]]
            columns = (steps, found.left, found.right, value)
            yield pa.record_batch(
                [
                    pa.array([block.number] * len(rows), pa.int64()),
                    pa.array([shard for shard, _, _ in rows], pa.int64()),
                    pa.array([b - a for _, a, b in rows], pa.int64()),
                    pa.array([_columns(*(x[a:b] for x in columns)) for _, a, b in rows], pa.binary()),
                ],
                ["doc_id", *(field.name for field in _OUTLINES)],
            )


_VERDICTS = "doc_id long, shard long, again binary, compare binary"


def _partners(half: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which contexts have a half that a different context has too."""
    order = np.lexsort((hashes, half))
    sorted_half, sorted_hashes = half[order], hashes[order]
    same = sorted_half[1:] == sorted_half[:-1]
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    other = np.concatenate([[False], same & (sorted_hashes[1:] != sorted_hashes[:-1])])
    found = np.zeros(len(half), bool)
    found[order] = np.repeat(np.logical_or.reduceat(other, heads), np.diff(np.append(heads, len(half))))
    return found


def _judged(count_docs: bool):
    """Step 3, shards: which contexts have to be compared window by window; of the others, which
    occur in a smaller document than any that holds them in this block, or more than once."""

    def answer(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        rows = [_rows_of(x, n, *_OUTLINE) for x, n in zip(table.column("outlines").to_pylist(), sizes)]
        hashes = np.concatenate([np.cumsum(row[0], dtype=np.uint64) for row in rows])
        left, right, value = (np.concatenate(x) for x in list(zip(*rows))[1:])
        compare = _partners(left, hashes) | _partners(right, hashes)
        distinct, place = np.unique(hashes, return_inverse=True)
        if count_docs:
            least = np.full(len(distinct), LAST_ID)
            np.minimum.at(least, place, value)
            again = least[place] < value
        else:
            again = np.bincount(place, weights=value)[place] > 1
        bounds = np.cumsum(sizes)[:-1]
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "shard": table.column("shard"),
                "again": _bits(np.split(again & ~compare, bounds)),
                "compare": _bits(np.split(compare, bounds)),
            }
        ).filter(pc.field("again").is_valid() | pc.field("compare").is_valid())

    return answer


def _verdicts(found: Entries, row: dict) -> tuple[np.ndarray, np.ndarray]:
    again, compare = (
        _filled(np.zeros(len(found.lo), bool), found.bounds, row["verdicts"], x) for x in ("again", "compare")
    )
    return again, compare


_CONTEXTS = [
    T.StructField("shard", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("entries", T.BinaryType()),
    T.StructField("text", T.BinaryType()),
]
_ENTRY = (np.int32, np.int32, np.int32, np.int64, np.int64, np.int64)


def _sent(batches: Batches, windows: Windows, n_shards: int, n_parts: int) -> Iterator[pa.RecordBatch]:
    """Step 4, blocks: contexts to compare, with the smallest and largest document that
    holds them, how often they occur, and their bytes."""
    for block, row in _blocks(batches, windows):
        found = _entries(block, row, n_shards, n_parts)
        _, compare = _verdicts(found, row)
        to = np.repeat(np.arange(n_shards), np.diff(found.bounds)) * n_parts + found.part
        chosen = np.flatnonzero(compare)
        if not len(chosen):
            continue
        chosen = chosen[np.argsort(to[chosen], kind="stable")]
        lo, hi, to = found.lo[chosen], found.hi[chosen], to[chosen]
        byte_lo, byte_hi = block.units.byte_range(lo, hi)
        cuts = np.flatnonzero(np.diff(to)) + 1
        rows = list(zip(np.concatenate([[0], cuts]), np.append(cuts, len(to))))
        columns = [lo, hi - lo, byte_hi - byte_lo, *(x[chosen] for x in (found.least, found.most, found.times))]
        columns = [x.astype(kind) for x, kind in zip(columns, _ENTRY)]
        yield pa.record_batch(
            [
                pa.array([block.number] * len(rows), pa.int64()),
                pa.array([int(to[a]) for a, _ in rows], pa.int64()),
                pa.array([int(b - a) for a, b in rows], pa.int64()),
                pa.array([_columns(*(x[a:b] for x in columns)) for a, b in rows], pa.binary()),
                pa.array(
                    [_compress(block.data[ranges(byte_lo[a:b], byte_hi[a:b] - byte_lo[a:b])]) for a, b in rows],
                    pa.binary(),
                ),
            ],
            ["doc_id", *(field.name for field in _CONTEXTS)],
        )


@dataclass
class Contexts:
    """The contexts a shard has received. Equal ones of several blocks are one row of
    ``distinct``; ``place`` leads from a received context to it."""

    units: Units
    prefixes: Prefixes
    starts: np.ndarray  # of distinct contexts, in units
    windows: np.ndarray  # how many windows each has
    least: np.ndarray
    times: np.ndarray
    place: np.ndarray

    def window_starts(self) -> np.ndarray:
        return ranges(self.starts, self.windows)


_ANSWERS = "doc_id long, runs binary, least binary"


def _compared(windows: Windows, resolve: Callable[[Contexts, int], np.ndarray]):
    """Step 4, shards. ``resolve`` gives, for every window of the distinct contexts in order, the
    smallest document that holds it; where documents do not count, -1 if it is not repeated."""

    def answer(table: pa.Table) -> pa.Table:
        counts = table.column("n").to_pylist()
        rows = [_rows_of(x, n, *_ENTRY) for x, n in zip(table.column("entries").to_pylist(), counts)]
        at, n_units, sizes, least, most, times = (np.concatenate(x).astype(np.int64) for x in zip(*rows))
        filled = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        lengths = np.diff(filled[np.concatenate([[0], ends])]).tolist()
        data = np.frombuffer(
            b"".join(
                _decompress(x, n) for x, n in zip(table.column("text").to_pylist(), lengths)
            ),
            np.uint8,
        )
        units = windows.cut(data, filled)
        starts = units.bounds[:-1]
        prefixes = Prefixes(units.values)
        hashes = mix(prefixes.of(starts, starts + n_units) + n_units.astype(np.uint64))
        _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        n = len(first)
        low, total = np.full(n, LAST_ID), np.zeros(n, np.int64)
        np.minimum.at(low, place, least)
        np.add.at(total, place, times)
        contexts = Contexts(
            units, prefixes, starts[first], n_units[first] - windows.width + 1, low, total, place
        )
        found = resolve(contexts, windows.width)
        # runs of windows with one answer, within a context
        owner = np.repeat(np.arange(n), contexts.windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(contexts.windows) - contexts.windows, contexts.windows)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
        heads = np.flatnonzero(new)
        lengths = np.diff(np.append(heads, len(owner)))
        if not windows.count_docs:  # else these are documents, whose ids may be negative
            use = found[heads] >= 0
            heads, lengths = heads[use], lengths[use]
        run_bounds = np.searchsorted(owner[heads], np.arange(n + 1))
        per = np.diff(run_bounds)[place]
        runs = ranges(run_bounds[:-1][place], per)
        begin = np.repeat(at, per) + inside[heads[runs]]
        value, length = found[heads[runs]], lengths[runs]
        row = np.repeat(np.repeat(np.arange(len(counts)), counts), per)
        if windows.count_docs:  # where nobody comes after the first holder, nothing is removed
            later = value < np.repeat(most, per)
            begin, length, value, row = begin[later], length[later], value[later], row[later]
        cuts = np.searchsorted(row, np.arange(len(counts) + 1))
        packed_runs = np.stack([begin, length], axis=1).astype(np.int32)
        numbers = table.column("doc_id").to_pylist()
        some = [i for i in range(len(counts)) if cuts[i] < cuts[i + 1]]
        return pa.table(
            {
                "doc_id": pa.array([numbers[i] for i in some], pa.int64()),
                "runs": pa.array([packed_runs[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                "least": pa.array([value[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
            }
        )

    return answer


def _marked(block: Block, row: dict, n_shards: int, n_parts: int) -> np.ndarray:
    """Step 5: which units of the block are covered by a repeated window."""
    width, n = block.windows.width, len(block.units.values)
    if not row["replies"]:
        return np.zeros(n, bool)
    found = _entries(block, row, n_shards, n_parts)
    again, compare = _verdicts(found, row)
    entry = np.repeat(np.arange(len(found.lo)), found.times)
    whole = again[entry]
    if block.windows.count_docs:  # a context may also be repeated within the block alone
        whole |= ~compare[entry] & (found.least[entry] < found.found_id)
    lo, hi = found.found_lo[whole], found.found_hi[whole]
    answers = row["answers"] or []
    runs = np.frombuffer(b"".join(x["runs"] for x in answers), np.int32).reshape(-1, 2).astype(np.int64)
    if len(runs):
        least = np.frombuffer(b"".join(x["least"] for x in answers), np.int64)
        by_lo = np.argsort(found.lo)
        of = by_lo[np.searchsorted(found.lo[by_lo], runs[:, 0], "right") - 1]
        at = ranges((np.cumsum(found.times) - found.times)[of], found.times[of])
        run = np.repeat(np.arange(len(runs)), found.times[of])
        if block.windows.count_docs:
            later = least[run] < found.found_id[at]
            at, run = at[later], run[later]
        begin = found.found_lo[at] + (runs[:, 0] - found.lo[of])[run]
        lo, hi = np.concatenate([lo, begin]), np.concatenate([hi, begin + runs[run, 1] + width - 1])
    change = np.bincount(lo, minlength=n + 1) - np.bincount(hi, minlength=n + 1)
    return np.cumsum(change[:-1]) > 0


def covered(
    docs: DataFrame,
    windows: Windows,
    resolve: Callable[[Contexts, int], np.ndarray],
    fields: list[T.StructField],
    result: Callable[[Block, np.ndarray], list[pa.Array]],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 2 << 20,
    shard_bytes: int = 8 << 20,
    hot_blocks: int = 1_024,
) -> DataFrame:
    """``doc_id`` and ``fields``, one row per row of ``docs``: what ``result`` makes of each block
    and the mask of its covered units."""
    blocks = packed(docs, doc_id, text, block_bytes)
    total = blocks.agg(F.sum(F.element_at("bounds", -1))).first()[0] or 0
    # hashes take less memory than texts: shards of keys are ``n_parts`` times those of texts
    n_parts = 4
    n_shards = max(1, math.ceil(total / (n_parts * shard_bytes)))
    id_type = docs.schema[doc_id].dataType

    named = map_batches(
        blocks,
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("keys", T.BinaryType()),
            T.StructField("again", T.BinaryType()),
        ],
        lambda batches: _named(batches, windows, n_shards),
    )
    masks = named.groupBy("shard").applyInArrow(_repeated(hot_blocks), _MASKS)
    replies = masks.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "mask", "hot")).alias("replies"))
    candidates = blocks.join(saved(replies, "replies"), "doc_id", "left")
    some = candidates.where(F.col("replies").isNotNull())

    outlines = map_batches(some, _OUTLINES, lambda batches: _outlined(batches, windows, n_shards, n_parts))
    judged = outlines.groupBy("shard").applyInArrow(_judged(windows.count_docs), _VERDICTS)
    verdicts = judged.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "again", "compare")).alias("verdicts"))
    candidates = candidates.join(saved(verdicts, "verdicts"), "doc_id", "left")
    some = candidates.where(F.col("verdicts").isNotNull())

    sent = map_batches(some, _CONTEXTS, lambda batches: _sent(batches, windows, n_shards, n_parts))
    answers = (
        sent.groupBy("shard")
        .applyInArrow(_compared(windows, resolve), _ANSWERS)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("runs", "least")).alias("answers"))
    )

    def finish(batches: Batches) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(field.name for field in fields)]
        for block, row in _blocks(batches, windows):
            mask = _marked(block, row, n_shards, n_parts)
            yield pa.record_batch([pa.array(block.raw_ids, pa.int64()), *result(block, mask)], names)

    found = map_batches(candidates.join(answers, "doc_id", "left"), fields, finish)
    return found.withColumn("doc_id", F.col("doc_id").cast(id_type))
