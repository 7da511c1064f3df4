"""N-gram Jaccard join by prefix trees: documents whose sets of n-grams are nearly the same.

A document's set holds its distinct shingles of ``n`` words (A-Z lower-cased); a text of fewer
words is one shingle, one without a word has an empty set and no link. Documents link when the
intersection of their sets is at least ``percent`` hundredths of the union. All links between
different sets count towards the components; equal sets are one class from the start and are
never paired.

1. Every text becomes a digest of its set; classes are the distinct digests.
2. Shingles get one order for all documents, the rare first, by how often each occurs: blocks of
   texts ask the shards that count shingles. Two sets that link share one of their first few
   shingles, so classes that share such a shingle and fit in size are joined into families, by the
   smallest class of each shingle and size band, never pair by pair. Most of the first shingles of
   a set occur nowhere else, and unlike sets seldom meet.
3. Within a family, sets go into a trie that every member is probed against. A family of more
   than ``tile`` classes is cut into tiles, and each pair of tiles is a group of its own.

A null or empty text is without a word. Rows with the same ``doc_id`` and different texts are
judged by their own text. A null ``doc_id`` is passed through and names no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, append, column, fresh, map_batches, narrow, saved, small
from trolley.llm.components import components
from trolley.llm.trie import SetTrie
from trolley.llm.word_hashes import Prefixes, mix, runs_of, slices, text_buffer
from trolley.operators import broadcast_if_small
from trolley.session import scratch_dir
from trolley.sinks.files import remove

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True

#: Text per block, shingles per shard, and the bits of the prints that shingles of a shard are counted
#: by: two shingles with one print count as one more frequent one, which changes the order alone.
_BLOCK_BYTES, _SHARD_SHINGLES, _PRINT_BITS = 4 << 20, 1 << 20, 27

#: The measured size up to which members are broadcast.
_SMALL = 16 << 20


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bounds, hashes): the distinct shingles of text ``first + i`` are
    ``hashes[bounds[i]:bounds[i + 1]]``, in ascending order."""
    data, bounds = text_buffer(texts)
    for first, end in slices(bounds):
        own = bounds[first : end + 1] - bounds[first]
        low = _LOWER[data[bounds[first] : bounds[end]]]
        starts, ends, docs = runs_of(~_BLANK[low], own)
        words = mix(Prefixes(low).of(starts, ends))
        n_words = np.bincount(docs, minlength=end - first)
        at = np.concatenate([[0], np.cumsum(n_words)])
        hashes, places = [], []
        if len(words) >= n:
            whole = words[: len(words) - n + 1].copy()
            for i in range(1, n):
                whole = mix(whole + np.uint64(i)) + words[i : len(words) - n + 1 + i]
            inside = docs[: len(whole)] == docs[n - 1 :]
            hashes.append(mix(whole[inside])), places.append(docs[: len(whole)][inside])
        for doc in np.flatnonzero((n_words > 0) & (n_words < n)):
            value = np.full(1, n_words[doc], np.uint64)
            for word in words[at[doc] : at[doc + 1]]:
                value = mix(value + word)
            hashes.append(value), places.append(np.array([doc]))
        hashes = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        places = np.concatenate(places or [np.zeros(0, np.int64)])
        order = np.lexsort((hashes, places))
        hashes, places = hashes[order], places[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (places[1:] != places[:-1])
        hashes, places = hashes[new], places[new]
        yield first, np.searchsorted(places, np.arange(end - first + 1)), hashes


def _digests(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two sums of 64 bits over each set."""
    sums = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(mix(hashes + np.uint64(11)), out=sums[0, 1:])
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
    return (sums[:, bounds[1:]] - sums[:, bounds[:-1]]).T.copy()


def _binary16(values: np.ndarray) -> pa.Array:
    n = len(values)
    offsets = pa.py_buffer(np.arange(0, 16 * n + 1, 16, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(values.tobytes())])


SET = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("digest", T.BinaryType()),
    T.StructField("node", T.LongType()),
]


def _digester(n: int):
    """``n_shingles``, ``digest`` and ``node`` (half a digest) of each row's set."""

    def digest(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.uint64)]
            for _, bounds, hashes in shingle_sets(column(batch, "text"), n):
                sizes.append(np.diff(bounds))
                digests.append(_digests(bounds, hashes))
            digests = np.concatenate(digests)
            nodes = np.ascontiguousarray(digests[:, 0]).view(np.int64)
            yield pa.record_batch(
                [column(batch, "doc_id"), pa.array(np.concatenate(sizes)), _binary16(digests), pa.array(nodes)],
                ["doc_id", "n_shingles", "digest", "node"],
            )

    return digest


# --- how often shingles occur -----------------------------------------------------------------


class _Pack:
    """Rows of a batch as few rows of packed texts."""

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, _BLOCK_BYTES):
            data, bounds = text_buffer(column(batch, "text"))
            packed = pa.compress(bounds.tobytes() + data.tobytes(), "zstd", asbytes=True)
            sizes = [len(bounds), 8 * len(bounds) + len(data)]
            yield pa.record_batch(
                [pa.array([0]), *(pa.array([size]) for size in sizes), pa.array([packed], pa.binary())],
                ["doc_id", "n_bounds", "n_bytes", "texts"],
            )


_BLOCK = [T.StructField(name, T.LongType()) for name in ("n_bounds", "n_bytes")]
_BLOCK.append(T.StructField("texts", T.BinaryType()))


def blocks_of(rows: DataFrame, path: str) -> DataFrame:
    """``block``, ``n_bounds``, ``n_bytes`` and ``texts``: all texts in rows of some MB, at ``path``."""
    keyed = rows.select(F.lit(0).cast("long").alias("doc_id"), "text")
    packed = map_batches(keyed, _BLOCK, _Pack()).withColumn("block", F.monotonically_increasing_id())
    packed.drop("doc_id").write.parquet(path)
    return rows.sparkSession.read.schema(packed.drop("doc_id").schema).parquet(path)


def _block_sets(n_bounds: int, n_bytes: int, packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes) of the shingle sets of a block's texts, in order."""
    data = pa.decompress(packed, n_bytes, "zstd")
    texts = pa.Array.from_buffers(
        pa.large_string(), n_bounds - 1, [None, data.slice(0, 8 * n_bounds), data.slice(8 * n_bounds)]
    )
    sizes, hashes = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
    for _, bounds, part in shingle_sets(texts, n):
        sizes.append(np.diff(bounds))
        hashes.append(part)
    return np.cumsum(np.concatenate(sizes)), np.concatenate(hashes)


def _dealt(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard and print of every shingle, in the order of both, and that order."""
    shard = (hashes >> np.uint64(32)) % np.uint64(shards)
    prints = mix(hashes) & np.uint64((1 << _PRINT_BITS) - 1)
    order = np.lexsort((prints, shard))
    return shard[order].astype(np.int64), prints[order].astype(np.uint32), order


def _planes(values: np.ndarray) -> bytes:
    """Numbers of four bytes, compressed byte by byte."""
    return pa.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _from_planes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _questions(blocks: DataFrame, n: int, shards: int) -> DataFrame:
    """``shard``, ``block``, ``n``, ``prints``: what a block holds of each shard."""

    def ask(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, hashes = _block_sets(row["n_bounds"], row["n_bytes"], row["texts"], n)
                shard, prints, _ = _dealt(hashes, shards)
                starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
                ends = np.append(starts[1:], len(shard)) if len(shard) else []
                parts = [(int(shard[a]), b - a, _planes(np.diff(prints[a:b], prepend=np.uint32(0)))) for a, b in zip(starts, ends)]
                yield pa.record_batch(
                    [
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([part[0] for part in parts], pa.int64()),
                        pa.array([part[1] for part in parts], pa.int64()),
                        pa.array([part[2] for part in parts], pa.binary()),
                    ],
                    ["doc_id", "shard", "n", "prints"],
                )

    fields = [T.StructField("shard", T.LongType()), T.StructField("n", T.LongType()), T.StructField("prints", T.BinaryType())]
    asked = blocks.select(F.col("block").alias("doc_id"), "block", "n_bounds", "n_bytes", "texts")
    return map_batches(asked, fields, ask).withColumnRenamed("doc_id", "block")


_ANSWER = "block long, shard long, n long, counts binary"


def _answer(table: pa.Table) -> pa.Table:
    """How often each print of a shard occurs, 255 for more, for every block that asked."""
    lengths = table.column("n").to_pylist()
    prints = [
        np.cumsum(_from_planes(data, n), dtype=np.uint32)
        for data, n in zip(table.column("prints").to_pylist(), lengths)
    ]
    _, place, counts = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
    counts = np.minimum(counts, 255).astype(np.uint8)[place]
    ends = np.cumsum(lengths)
    replies = [pa.compress(counts[end - n : end].tobytes(), "zstd", asbytes=True) for end, n in zip(ends, lengths)]
    return pa.table(
        [table.column("block"), table.column("shard"), table.column("n"), pa.array(replies, pa.binary())],
        ["block", "shard", "n", "counts"],
    )


_POSTINGS = [
    T.StructField("shard", T.LongType()),
    *(T.StructField(name, T.BinaryType()) for name in ("shingles", "bands", "hubs", "a", "b")),
]


def early_shingles(
    bounds: np.ndarray, hashes: np.ndarray, counts: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """(set, shingle) for the first shingles of each set in the common order, by ``counts``: as many
    as a linked set cannot miss all of, without those that nobody else has."""
    sizes = np.diff(bounds)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, counts, docs))
    length = sizes - -(-percent * sizes // 100) + 1
    early = np.arange(len(hashes)) - np.repeat(bounds[:-1], sizes) < np.repeat(length, sizes)
    early &= counts[order] > 1
    return docs[order[early]], hashes[order[early]]


def _size_bands(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Linked sets differ in size by 100 / percent at most, hence by one band at most."""
    if percent == 100:
        return sizes
    return np.floor(np.log(np.maximum(sizes, 1)) / math.log(100 / percent) + 1e-9).astype(np.int64)


def _postings(blocks: DataFrame, answers: DataFrame, n: int, percent: int, shards: int) -> DataFrame:
    """Per block and shard of shingles: its early shingles by size band, for each the smallest
    node of the block (its hub), and edges from the other nodes to the hub."""

    def cut(block: pa.Table, told: pa.Table) -> pa.Table:
        nothing = pa.table([pa.array([], pa.int64()), *(pa.array([], pa.binary()) for _ in _POSTINGS[1:])], names)
        if not block.num_rows or not told.num_rows:  # no shingle at all
            return nothing
        (row,) = block.to_pylist()
        bounds, hashes = _block_sets(row["n_bounds"], row["n_bytes"], row["texts"], n)
        _, _, asked = _dealt(hashes, shards)
        told = sorted(told.select(["shard", "n", "counts"]).to_pylist(), key=lambda part: part["shard"])
        counts = np.empty(len(hashes), np.uint8)
        counts[asked] = np.frombuffer(
            b"".join(pa.decompress(part["counts"], part["n"], "zstd", asbytes=True) for part in told), np.uint8
        )
        sets, shingles = early_shingles(bounds, hashes, counts, percent)
        if not len(sets):
            return nothing
        nodes = np.ascontiguousarray(_digests(bounds, hashes)[:, 0]).view(np.int64)[sets]
        bands = _size_bands(np.diff(bounds), percent)[sets]
        shard = (shingles >> np.uint64(32)) % np.uint64(shards)
        order = np.lexsort((nodes, bands, shingles, shard))
        shard, shingles, bands, nodes = (x[order] for x in (shard, shingles, bands, nodes))
        new = np.ones(len(order), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (bands[1:] != bands[:-1])
        hubs = nodes[new][np.cumsum(new) - 1]
        edge = nodes != hubs
        a, b, edge_shards = nodes[edge], hubs[edge], shard[edge]
        shingles, bands, hubs, hub_shards = shingles[new], bands[new], hubs[new], shard[new]
        present = np.unique(hub_shards)
        at = np.searchsorted(hub_shards, present), np.searchsorted(hub_shards, present, "right")
        edge_at = np.searchsorted(edge_shards, present), np.searchsorted(edge_shards, present, "right")

        def packed(values: np.ndarray, kind, bounds) -> pa.Array:
            return pa.array([values[x:y].astype(kind).tobytes() for x, y in zip(*bounds)], pa.binary())

        return pa.table(
            [
                pa.array(present.astype(np.int64)),
                packed(shingles, np.uint64, at),
                packed(bands, np.int32, at),
                packed(hubs, np.int64, at),
                packed(a, np.int64, edge_at),
                packed(b, np.int64, edge_at),
            ],
            names,
        )

    names = [field.name for field in _POSTINGS]
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, T.StructType(_POSTINGS))


def _edges_of_shard(table: pa.Table) -> pa.Table:
    """Edges between the hubs of one shingle, within a size band and to the next band, and those
    of the batches. A batch has one hub per shingle and band, however many sets hold it."""

    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    shingles, bands, hubs = joined("shingles", np.uint64), joined("bands", np.int32), joined("hubs", np.int64)
    order = np.lexsort((hubs, bands, shingles))
    shingles, bands, hubs = shingles[order], bands[order].astype(np.int64), hubs[order]
    new = np.ones(len(order), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (bands[1:] != bands[:-1])
    least = hubs[new][np.cumsum(new) - 1]
    heads = np.flatnonzero(new)
    next_band = np.flatnonzero(
        (shingles[heads[1:]] == shingles[heads[:-1]]) & (bands[heads[1:]] == bands[heads[:-1]] + 1)
    )
    a = np.concatenate([hubs, hubs[heads[1:]][next_band], joined("a", np.int64)])
    b = np.concatenate([least, hubs[heads[:-1]][next_band], joined("b", np.int64)])
    pairs = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def families(rows: DataFrame, n: int, percent: int, n_shingles: int) -> DataFrame:
    """``node`` and ``family``: connected over early shingles and fitting sizes. Sets alone with
    all their early shingles have no family and no link. ``n_shingles``: in all sets together."""
    shards = max(1, -(-n_shingles // _SHARD_SHINGLES))
    path = scratch_dir(rows.sparkSession, "shingle-blocks")
    blocks = blocks_of(rows, path)
    answers = _questions(blocks, n, shards).groupBy("shard").applyInArrow(_answer, _ANSWER)
    postings = _postings(blocks, answers, n, percent, shards)
    found = components(postings.groupBy("shard").applyInArrow(_edges_of_shard, "a long, b long"))
    remove(rows.sparkSession, [path])  # the components are a checkpoint that nothing leads back from
    return found.select("node", F.col("root").alias("family")).unionByName(
        found.select(F.col("root").alias("node"), F.col("root").alias("family")).distinct()
    )


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)


def linked(sets: list[np.ndarray], percent: int, probes: list[int]) -> _Union:
    """Components of some sets: each probe against a trie of all, common shingles first."""
    values, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(values))
    ends = np.cumsum([len(s) for s in sets])
    ordered = [np.sort(rank[at[end - len(s) : end]]) for s, end in zip(sets, ends)]
    trie, union = SetTrie(ordered, len(values)), _Union(len(sets))
    for i in probes:
        for j in trie.probe(ordered[i], percent):
            union.join(i, int(j))
    return union


_LINKS = "a binary, b binary"


def _join_bin(n: int, percent: int):
    """Trie join of every family, or pair of tiles, in a group of rows."""

    def join(table: pa.Table) -> pa.Table:
        digests, sets = [], []
        for batch in table.select(["text"]).to_batches():
            for _, bounds, hashes in shingle_sets(column(batch, "text"), n):
                digests += [x.tobytes() for x in _digests(bounds, hashes)]
                sets += np.split(hashes, bounds[1:-1])
        wanted = table.column("digest").to_pylist()
        tiles = table.column("tile").to_pylist()
        groups: dict[tuple, dict[bytes, int]] = {}
        keys = zip(table.column("family").to_pylist(), table.column("low").to_pylist(), table.column("high").to_pylist())
        for i, key in enumerate(keys):
            if digests[i] == wanted[i]:  # else another text under the same doc_id
                groups.setdefault(key, {}).setdefault(wanted[i], i)
        a, b = [], []
        for (_, low, high), members in groups.items():
            rows = list(members.values())
            probes = [k for k, i in enumerate(rows) if tiles[i] == low]
            union = linked([sets[i] for i in rows], percent, probes)
            for k, i in enumerate(rows):
                root = union.find(k)
                if root != k:
                    a.append(wanted[i]), b.append(wanted[rows[root]])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return join


def _tiled(members: DataFrame, tile: int) -> DataFrame:
    """Members with the bin they are joined in, and for large families once per pair of tiles."""
    sizes = members.groupBy("family").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    tiles = F.ceil(F.col("size") / tile)
    own = F.pmod(F.xxhash64("digest"), tiles)
    paired = (
        members.join(sizes, "family")
        .withColumn("tile", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .withColumn("low", F.least("tile", "other"))
        .withColumn("high", F.greatest("tile", "other"))
    )
    small = F.col("size") <= tile
    bins = max(1, math.ceil(total / tile))
    return paired.withColumn(
        "bin",
        F.when(small, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(
            F.xxhash64("family", "low", "high")
        ),
    )


def _components_of(rows: DataFrame, sets: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """``digest`` and ``component_id`` of every set that is not empty."""
    n_shingles = sets.agg(F.sum("n_shingles")).first()[0] or 0
    classes = (
        sets.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("smallest"), F.any_value("node").alias("node"))
    )
    found = families(rows, n, percent, n_shingles)
    members = classes.join(found, "node").select("family", "digest", "smallest")
    tiled = _tiled(saved(members, "families"), tile).withColumnRenamed("smallest", "doc_id")
    tiled = broadcast_if_small(saved(tiled, "tiles"), _SMALL)  # else both sides are shuffled
    # sets that only rows without an id hold are fetched by their digest
    nameless = append(rows.where("doc_id IS NULL"), SET, _digester(n)).select("digest", "text")
    texts = (
        tiled.join(rows, "doc_id")
        .unionByName(
            tiled.where("doc_id IS NULL").join(nameless.dropDuplicates(["digest"]), "digest"),
            allowMissingColumns=True,
        )
        .select("bin", "family", "low", "high", "tile", "digest", "text")
    )
    links = texts.groupBy("bin").applyInArrow(_join_bin(n, percent), _LINKS)
    roots = components(links)
    classed = classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", "smallest", F.coalesce("root", "digest").alias("root")
    )
    smallest = classed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return classed.join(smallest, "root").select("digest", "component_id")


def near_components(
    docs: DataFrame,
    *,
    n: int = 3,
    percent: int = 90,
    tile: int = 500,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest ``doc_id`` reachable by
    links), one row per row of ``docs``."""
    rows = narrow(docs, doc_id, text)
    sets = saved(map_batches(rows, SET, _digester(n)), "shingle-sets")
    named = _components_of(rows, sets, n, percent, tile)
    return sets.join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def firsts(
    docs: DataFrame,
    *,
    n: int = 3,
    percent: int = 90,
    tile: int = 500,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their own columns, that are the first of their component: one
    row of each group stays. Rows without a word are in no group and all stay."""
    rows = narrow(docs, doc_id, text)
    size, digest, node = (fresh(docs, field.name) for field in SET)
    tagged = append(docs, SET, _digester(n), doc_id=doc_id, text=text)
    sets = saved(
        tagged.select(
            F.col(doc_id).alias("doc_id"),
            *(F.col(name).alias(field.name) for name, field in zip((size, digest, node), SET)),
        ),
        "shingle-sets",
    )
    component = fresh(docs, "component_id")
    named = _components_of(rows, sets, n, percent, tile).select(
        F.col("digest").alias(digest), F.col("component_id").alias(component)
    )
    kept = tagged.join(named, digest, "left").where(
        (F.col(size) == 0) | F.col(component).isNull() | (F.col(component) == F.col(doc_id))
    )
    grouped = sets.where("n_shingles > 0").groupBy("doc_id", "digest").count()
    if not grouped.where("count > 1").isEmpty():  # rows repeated as a whole: one of them
        empty, some = kept.where(F.col(size) == 0), kept.where(F.col(size) > 0)
        kept = some.dropDuplicates([doc_id, digest]).unionByName(empty)
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))
