"""Line dedup with sharded cuckoo filters backed by exact reference counts.

A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least
``least_chars`` code points that occur in at least two documents lose their lines everywhere but
in the smallest ``doc_id`` that holds them.

``LineIndex`` keeps, below one folder, which document holds which key (``postings``), one chain
of cuckoo filters per shard of keys (``filters``), and the documents counted and the smallest
one for keys held more than once (``references``). A batch of documents asks the filters which
of its keys may be known; only those are counted exactly. A key that is new by the exact tables
gets a print of its own even where it looks known, so that each held key owns one. Taking documents out lowers the
counts, and keys that nobody holds any more leave the filters, so that an insertion can be
undone. Every change writes a new version; a version is never altered.

Rows with the same ``doc_id`` are one document. A null ``doc_id`` counts as a document larger
than any other; a null or empty text is one empty line, which is too short to be dropped.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, column, fresh, map_batches, narrow, small
from trolley.llm.cuckoo import CuckooFilter
from trolley.session import scratch_dir

_BLANK = b" \t\n\x0b\x0c\r"
_NULL_ID = (1 << 63) - 1


def key_of(line: bytes, least_chars: int) -> bytes | None:
    """Digest of a line's key; None where the key is too short to count."""
    key = line.strip(_BLANK).lower()  # bytes: only A-Z change
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode()) < least_chars:
        return None
    return blake2b(key, digest_size=16).digest()


def line_keys(rows: DataFrame, least_chars: int) -> DataFrame:
    """``doc_id`` and ``key``, each once per row; ``first`` marks the first row of a key in a
    batch, and ``again`` keys that another document of the batch holds too."""

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 8 << 20):
            places, keys, holders = [], [], {}
            for i, text in enumerate(column(batch, "text")):
                own = {key_of(line, least_chars) for line in (text.as_py() or "").encode().split(b"\n")}
                own.discard(None)
                places += [i] * len(own)
                keys += own
                for key in own:
                    holders[key] = holders.get(key, 0) + 1
            first, seen = [], set()
            for key in keys:
                first.append(key not in seen)
                seen.add(key)
            yield pa.record_batch(
                [
                    column(batch, "doc_id").take(pa.array(places, pa.int64())),
                    pa.array(keys, pa.binary()),
                    pa.array(first, pa.bool_()),
                    pa.array([holders[key] > 1 for key in keys], pa.bool_()),
                ],
                ["doc_id", "key", "first", "again"],
            )

    fields = [
        T.StructField("key", T.BinaryType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("again", T.BooleanType()),
    ]
    return map_batches(rows, fields, cut)


_FILTERS = "shard int, key binary, asked boolean, filter binary"


def _hashes(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The first 8 bytes of the digests, as numbers."""
    return np.frombuffer(b"".join(key[:8] for key in keys.to_pylist()), np.uint64)


def _stored(shard: int, chain: CuckooFilter, keys: tuple[bytes, ...] = (), asked: tuple[bool, ...] = ()) -> pa.Table:
    n = len(keys) + 1
    return pa.table(
        {
            "shard": pa.array([shard] * n, pa.int32()),
            "key": pa.array([*keys, None], pa.binary()),
            "asked": pa.array([*asked, False], pa.bool_()),
            "filter": pa.array([None] * len(keys) + [pickle.dumps(chain)], pa.binary()),
        }
    )


def _probe(known: pa.Table, new: pa.Table) -> pa.Table:
    """Put the new keys of a shard into its filter; returns those that may have been there, and
    the filter. ``asked`` are keys that look like members of an earlier version and are not put
    in: whether they are is for the exact tables to say."""
    shard = (new if new.num_rows else known).column("shard")[0].as_py()
    kept = [pickle.loads(value) for value in known.column("filter").to_pylist() if value]
    chain = kept[0] if kept else CuckooFilter(max(64, new.num_rows))
    maybe: list[bytes] = []
    alike: list[bytes] = []
    put = [pa.array([], pa.binary())]
    for batch in new.to_batches(max_chunksize=1 << 16):
        keys = column(batch, "key")
        hashes = _hashes(keys)
        unique, at = np.unique(hashes, return_index=True)
        repeated = np.ones(len(hashes), bool)
        repeated[at] = chain.contains(unique)
        fresh = ~repeated
        alike += keys.filter(pa.array(repeated)).to_pylist()
        repeated |= column(batch, "again").to_numpy(zero_copy_only=False)
        chain.insert(hashes[fresh])
        put.append(keys.filter(pa.array(fresh)))
        maybe += keys.filter(pa.array(repeated)).to_pylist()
    looked = pa.array(list(dict.fromkeys(alike)), pa.binary())
    own = pa.chunked_array(put, pa.binary())
    own = own.filter(pc.is_in(own, value_set=looked)).combine_chunks()  # put in by this batch
    asked = looked.filter(pc.invert(pc.is_in(looked, value_set=own)))
    if not kept:  # nothing was there before: all of them are new
        chain.insert(_hashes(asked))
        asked = asked.slice(0, 0)
    unsure = set(asked.to_pylist())
    keys = tuple(dict.fromkeys(maybe))
    return _stored(shard, chain, keys, tuple(key in unsure for key in keys))


def _kept(known: pa.Table) -> tuple[int, CuckooFilter] | None:
    kept = [pickle.loads(value) for value in known.column("filter").to_pylist() if value]
    return (known.column("shard")[0].as_py(), kept[0]) if kept else None


_NO_FILTER = pa.schema([("shard", pa.int32()), ("key", pa.binary()), ("asked", pa.bool_()), ("filter", pa.binary())])


def _add(known: pa.Table, new: pa.Table) -> pa.Table:
    """The filter of a shard with keys that looked like members and are none."""
    if (held := _kept(known)) is None:
        return _NO_FILTER.empty_table()
    held[1].insert(_hashes(new.column("key")))
    return _stored(*held)


def _forget(known: pa.Table, gone: pa.Table) -> pa.Table:
    """The filter of a shard without keys that nobody holds any more."""
    if (held := _kept(known)) is None:
        return _NO_FILTER.empty_table()
    held[1].remove(_hashes(gone.column("key")))
    return _stored(*held)


@dataclass(frozen=True)
class LineIndex:
    """A version of the index: the folders of its tables."""

    spark: SparkSession
    shards: int
    least_chars: int
    postings_paths: tuple[str, ...] = ()
    filters_path: str | None = None
    references_path: str | None = None

    @classmethod
    def empty(cls, spark: SparkSession, *, shards: int | None = None, least_chars: int = 10) -> LineIndex:
        """``shards`` bounds how many keys one task holds in a filter (two bytes each)."""
        return cls(spark, shards or int(spark.conf.get("spark.sql.shuffle.partitions")), least_chars)

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(*self.postings_paths)

    def filters(self) -> DataFrame:
        if self.filters_path is None:
            return self.spark.createDataFrame([], _FILTERS)
        return self.spark.read.parquet(self.filters_path).where("key IS NULL")

    def references(self) -> DataFrame:
        """``key``, ``documents`` (2 and more) and ``smallest``, exact."""
        if self.references_path is None:
            return self.spark.createDataFrame([], "key binary, documents long, smallest long")
        return self.spark.read.parquet(self.references_path)

    def _written(self, table: DataFrame, name: str) -> str:
        path = scratch_dir(self.spark, f"line-{name}")
        table.write.parquet(path)
        return path

    def _counted(self, keys: DataFrame, paths: tuple[str, ...]) -> DataFrame:
        """Exact counts of candidate keys, from everything that holds them."""
        holders = self.spark.read.parquet(*paths).select("key", "doc_id").join(keys, "key", "left_semi")
        return (
            holders.groupBy("key")
            .agg(F.count_distinct("doc_id").alias("documents"), F.min("doc_id").alias("smallest"))
            .where("documents > 1")
        )

    def insert(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """A version with ``docs`` added."""
        rows = narrow(docs, doc_id, text).withColumn(
            "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
        )
        added = self._written(line_keys(rows, self.least_chars), "postings")
        new = self.spark.read.parquet(added).where("first").select(self._shard(), "key", "again")
        probed = (
            self.filters().groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_probe, _FILTERS)
        )
        filters = self._written(probed, "filters")
        candidates = self.spark.read.parquet(filters).where("key IS NOT NULL").select("key")
        if self.postings_paths:
            asked = self.spark.read.parquet(filters).where("asked").select("shard", "key")
            held = self.postings().join(asked, "key", "left_semi").select("key").distinct()
            missed = asked.join(held, "key", "left_anti").select("shard", "key")
            stored = self.spark.read.parquet(filters).where("key IS NULL").groupBy("shard")
            filters = self._written(stored.cogroup(missed.groupBy("shard")).applyInArrow(_add, _FILTERS), "filters")
        paths = (*self.postings_paths, added)
        counted = self._counted(candidates, paths)
        untouched = self.references().join(candidates, "key", "left_anti")
        references = self._written(untouched.unionByName(counted), "references")
        return LineIndex(self.spark, self.shards, self.least_chars, paths, filters, references)

    def delete(self, ids: DataFrame, *, doc_id: str = "doc_id") -> LineIndex:
        """A version without the documents whose ids are given."""
        ids = ids.select(
            F.coalesce(ids[doc_id].cast("long"), F.lit(_NULL_ID)).alias("doc_id")
        ).distinct()
        postings = self.postings()
        path = (self._written(postings.join(ids, "doc_id", "left_anti"), "postings"),)
        touched = postings.join(ids, "doc_id", "left_semi").select("key").distinct()
        gone = touched.join(self.spark.read.parquet(*path), "key", "left_anti")
        # shards without a lost key keep their filter as it is
        lost = gone.select(self._shard(), "key")
        forgotten = (
            self.filters().groupBy("shard").cogroup(lost.groupBy("shard")).applyInArrow(_forget, _FILTERS)
        )
        filters = self._written(forgotten, "filters")
        counted = self._counted(touched, path)
        untouched = self.references().join(touched, "key", "left_anti")
        references = self._written(untouched.unionByName(counted), "references")
        return LineIndex(self.spark, self.shards, self.least_chars, path, filters, references)

    def drops(self) -> DataFrame:
        """``doc_id`` and the ``keys`` whose lines it loses."""
        return (
            self.postings()
            .select("key", "doc_id")
            .join(self.references(), "key")
            .where(F.col("doc_id") != F.col("smallest"))
            .groupBy("doc_id")
            .agg(F.collect_set("key").alias("keys"))
        )


KEPT = [
    T.StructField("n_lines", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
    T.StructField("kept", T.StringType()),
]


def _with_keys(docs: DataFrame, index: LineIndex, doc_id: str, name: str) -> DataFrame:
    """``docs`` with the keys that each row's document drops."""
    dropping = fresh(docs, "dropping")
    drops = index.drops().select(F.col("doc_id").alias(dropping), F.col("keys").alias(name))
    own = F.coalesce(docs[doc_id].cast("long"), F.lit(_NULL_ID))
    return docs.join(drops, own == drops[dropping], "left").drop(dropping)


def _cutter(least_chars: int):
    def cut(batch: pa.RecordBatch, text: str, keys: str) -> list[pa.Array]:
        """Lines before, lines dropped, and text kept, of each row."""
        kept, n_lines, n_dropped = [], [], []
        for value, gone in zip(column(batch, text), column(batch, keys)):
            lines = (value.as_py() or "").encode().split(b"\n")
            n_lines.append(len(lines))
            lost = set(gone.as_py() or ())
            if lost:
                lines = [line for line in lines if key_of(line, least_chars) not in lost]
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(b"\n".join(lines))
        return [
            pa.array(n_lines, pa.int64()),
            pa.array(n_dropped, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]

    return cut


def cut_lines(docs: DataFrame, index: LineIndex, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_lines`` (before), ``n_dropped`` and the text that is ``kept``, one row
    per row of ``docs``, all of which are in the index."""
    cut = _cutter(index.least_chars)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            yield pa.record_batch(
                [column(batch, "doc_id"), *cut(batch, "text", "keys")],
                ["doc_id", *(field.name for field in KEPT)],
            )

    return map_batches(_with_keys(narrow(docs, doc_id, text), index, "doc_id", "keys"), KEPT, run)


def rewritten(docs: DataFrame, *, least_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_chars``, if there, counted anew."""
    index = LineIndex.empty(docs.sparkSession, least_chars=least_chars).insert(docs, doc_id=doc_id, text=text)
    keys, cut = fresh(docs, "keys"), _cutter(least_chars)
    names = docs.columns

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = cut(batch, text, keys)[2]
            yield pa.record_batch([kept if name == text else column(batch, name) for name in names], names)

    changed = _with_keys(docs, index, doc_id, keys).mapInArrow(run, docs.schema)
    if "n_chars" in names:
        changed = changed.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return changed


def dedup_lines(docs: DataFrame, *, least_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Dedup of one table by itself: a fresh index of all its documents, and what they keep."""
    index = LineIndex.empty(docs.sparkSession, least_chars=least_chars)
    index = index.insert(docs, doc_id=doc_id, text=text)
    return cut_lines(docs, index, doc_id=doc_id, text=text)
