"""Collocations: phrases of two to four words that occur more often than their parts suggest.

A suffix starts at every word and ends after four words, with its piece of text, or before a pair of
words that is too rare for any phrase. Suffixes are dealt out over all tasks by their leading words
and sorted there by multikey three-way quicksort, in which the sizes of equal parts are the counts
and parts that are too small are abandoned (``suffix_sort``).

What is dealt out, and where, follows from two counts of leading words:

* words, counted exactly. They are known by 64-bit hashes from then on; no word that is frequent
  enough shares its hash with another one of its language, or another seed is taken.
* leading pairs of frequent words, counted by hash. Rare ones are left out by a bitmap of bounded
  size, which at worst lets rare pairs pass, and they are abandoned later. The suffixes of a very
  frequent pair are dealt by all of their words, and their counts summed up afterwards, so that no
  leading pair fills a task, however frequent it is.

Equal suffixes of a block of text are sent once, with their number. Texts are lower-cased A-Z and cut
at ``.,;:!?`` and line breaks into pieces, and these at blanks and tabs into words. A null language
is ``und``, null and empty texts have no words. A text of any length is read in blocks that end with
a piece. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.llm.arrow_maps import Batches, _importable, column, saved, small
from trolley.llm.suffix_sort import prefix_counts
from trolley.llm.word_hashes import mix, runs_of, text_buffer

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPLIT = np.zeros(256, bool)
_SPLIT[[*b".,;:!?", *range(10, 14)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True

LONGEST = 4
#: Bytes of text that are tokenized at once, and pointers that are sorted at once.
_BLOCK, _SHARD = 4 << 20, 1 << 18
#: Bits of a bitmap: so many per entry, and at most (32 MB); it lets some more pass beyond.
_BITS_PER_ENTRY, _MOST_BITS, _CHUNK_BITS = 32, 1 << 28, 1 << 15


# --- texts into numbers -----------------------------------------------------------------------


@dataclass
class Block:
    """Words of a block of text, in order."""

    names: list[str]  # of the languages
    lang: np.ndarray  # of each word
    seeds: np.ndarray  # a number for the language of each word
    ids: np.ndarray  # of each word, in ``words``
    words: pa.Array
    hashes: np.ndarray  # of each word
    follows: np.ndarray  # whether the next word belongs to the same piece


def _ends(data: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Blocks [first, end) that end with a text or a piece."""
    cuts = np.union1d(np.flatnonzero(_SPLIT[data]) + 1, bounds)
    first = 0
    while first < len(data):
        at = int(np.searchsorted(cuts, first + size, "right")) - 1
        end = int(cuts[at]) if cuts[at] > first else int(cuts[at + 1])
        yield first, end
        first = end


@dataclass(frozen=True)
class Cut:
    """How texts are read: the seed of the hashes of words, the bytes of a block."""

    seed: int
    size: int


def blocks(batches: Batches, cut: Cut) -> Iterator[Block]:
    for batch in small(batches, cut.size):
        buffer, bounds = text_buffer(column(batch, "text"))
        langs = column(batch, "lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        by_name = np.array([xxhash.xxh3_64_intdigest(name, cut.seed) for name in names], np.uint64)
        of_text = langs.indices.to_numpy()
        for first, end in _ends(buffer, bounds, cut.size):
            data = _LOWER[buffer[first:end]]
            own = np.clip(bounds - first, 0, end - first)
            split = _SPLIT[data]
            inside = ~(split | _BLANK[data])
            starts, ends, docs = runs_of(inside, own)
            if not len(starts):
                continue
            offsets = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts, out=offsets[1:])
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
            coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
            table = [xxhash.xxh3_64_intdigest(word, cut.seed) or 1 for word in coded.dictionary.to_pylist()]
            ids = coded.indices.to_numpy()
            pieces = np.cumsum(split)[starts]
            follows = np.zeros(len(starts), bool)
            follows[:-1] = (pieces[1:] == pieces[:-1]) & (docs[1:] == docs[:-1])
            lang = of_text[docs]
            pa.default_memory_pool().release_unused()
            yield Block(names, lang, by_name[lang], ids, coded.dictionary, np.array(table, np.uint64)[ids], follows)


def _word_keys(block: Block) -> np.ndarray:
    return mix(block.hashes ^ block.seeds)


def _pair_keys(block: Block) -> np.ndarray:
    """Of each word but the last and the one behind it."""
    return mix(mix(block.hashes[:-1] ^ block.seeds[:-1]) + block.hashes[1:])


def _map(texts: DataFrame, function, schema: str) -> DataFrame:
    _importable(texts)
    return texts.mapInArrow(function, schema)


# --- leading words ----------------------------------------------------------------------------


def word_counts(texts: DataFrame, cut: Cut) -> DataFrame:
    """``lang``, ``hash``, ``key``, ``word``, ``n``: all words of all texts, exactly."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, cut):
            width = len(block.words)
            coded = block.lang.astype(np.int64) * width + block.ids
            _, first, n = np.unique(coded, return_index=True, return_counts=True)
            words = block.words.take(pa.array(block.ids[first])).cast(pa.large_string())
            langs = pa.array(block.names).take(pa.array(block.lang[first]))
            keys = _word_keys(block)[first].view(np.int64)
            arrays = [langs, pa.array(block.hashes[first].view(np.int64)), pa.array(keys), words.cast(pa.string()), pa.array(n)]
            yield pa.record_batch(arrays, ["lang", "hash", "key", "word", "n"])

    counted = _map(texts, count, "lang string, hash long, key long, word string, n long")
    return counted.groupBy("lang", "hash", "key", "word").agg(F.sum("n").alias("n"))


def clashes(words: DataFrame, least: int) -> bool:
    """Whether a word that occurs ``least`` times shares its hash with another of its language."""
    shared = words.groupBy("lang", "hash").agg(F.count("*").alias("words"), F.max("n").alias("most"))
    return not shared.where((F.col("words") > 1) & (F.col("most") >= least)).isEmpty()


def bitmap(entries: DataFrame, n: int) -> np.ndarray:
    """Bits at the places of ``key``, at most 32 MB whatever the number of entries."""
    bits = min(max(_CHUNK_BITS, 1 << (n * _BITS_PER_ENTRY).bit_length()), _MOST_BITS)
    place = F.col("key").bitwiseAND(F.lit(bits - 1))
    chunks = entries.groupBy(F.shiftright(place, 15).alias("chunk")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit(_CHUNK_BITS - 1))).alias("bits")
    )
    whole = np.zeros(bits // 8, np.uint8)
    for chunk, held in chunks.collect():
        at = chunk * (_CHUNK_BITS // 8)
        whole[at : at + len(held)] = np.frombuffer(held, np.uint8)
    return whole


def _in(whole: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & np.uint64(len(whole) * 8 - 1)
    return (whole[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def pair_counts(texts: DataFrame, cut: Cut, words) -> DataFrame:
    """``key`` and ``n`` of pairs of words that are in the bitmap ``words``."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, cut):
            known = _in(words.value, _word_keys(block))
            keys = _pair_keys(block)[block.follows[:-1] & known[:-1] & known[1:]]
            keys, n = np.unique(keys, return_counts=True)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    return _map(texts, count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


# --- suffixes ---------------------------------------------------------------------------------


def _suffixes(block: Block, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Language, words (0 behind the end), number and leading pair of each distinct suffix."""
    n = len(block.ids)
    known = _in(words, _word_keys(block))
    heads = _pair_keys(block)
    goes_on = np.zeros(n + LONGEST, bool)
    goes_on[: n - 1] = block.follows[:-1] & known[:-1] & known[1:] & _in(pairs, heads)
    at = np.flatnonzero(goes_on[:n])
    keys = np.zeros((LONGEST, len(at)), np.uint64)
    keys[0], reach = block.hashes[at], np.ones(len(at), bool)
    for i in range(1, LONGEST):
        reach &= goes_on[at + i - 1]
        keys[i, reach] = block.hashes[at[reach] + i]
    lang = block.lang[at]
    order = np.lexsort((*keys[::-1], lang))
    keys, lang, heads = keys[:, order], lang[order], heads[at][order]
    new = np.ones(len(at), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return lang[first], keys[:, first], np.diff(np.append(first, len(at))), heads[first]


def _packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    return pa.compress(keys.tobytes() + n.astype(np.int64).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, rows: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(pa.decompress(data, rows * (LONGEST + 1) * 8, "zstd", asbytes=True), np.uint64)
    return numbers[: rows * LONGEST].reshape(LONGEST, rows), numbers[rows * LONGEST :].view(np.int64)


def dealt_suffixes(texts: DataFrame, cut: Cut, words, pairs, hot, shards: int) -> DataFrame:
    """Suffixes of leading pairs in the bitmap ``pairs``, packed by ``shard``, language and whether
    the pair is ``hot``."""

    def deal(batches: Batches) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, cut):
            lang, keys, n, heads = _suffixes(block, words.value, pairs.value)
            if not len(n):
                continue
            is_hot = _in(hot.value, heads)
            whole = heads.copy()
            for i in range(2, LONGEST):
                whole = mix(whole + keys[i])
            shard = (np.where(is_hot, whole, heads) >> np.uint64(8)) % np.uint64(shards)
            group = (shard.astype(np.int64) * len(block.names) + lang) * 2 + is_hot
            order = np.argsort(group, kind="stable")
            group, keys, n = group[order], keys[:, order], n[order]
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            ends = np.append(starts[1:], len(group))
            rows = [
                {
                    "shard": int(group[a]) // (2 * len(block.names)),
                    "lang": block.names[int(group[a]) // 2 % len(block.names)],
                    "hot": bool(group[a] & 1),
                    "rows": int(b - a),
                    "suffixes": _packed(keys[:, a:b], n[a:b]),
                }
                for a, b in zip(starts, ends)
            ]
            yield pa.RecordBatch.from_pylist(rows, _DEALT)

    return _map(texts, deal, "shard long, lang string, hot boolean, rows long, suffixes binary")


_DEALT = pa.schema(
    [("shard", pa.int64()), ("lang", pa.string()), ("hot", pa.bool_()), ("rows", pa.int64()), ("suffixes", pa.binary())]
)
_GRAM = "lang string, " + ", ".join(f"h{i} long" for i in range(LONGEST)) + ", n long"


def phrase_counts(dealt: DataFrame, least: int) -> DataFrame:
    """``lang``, the hashes of the words as ``g`` and the count ``a`` of every phrase that occurs
    ``least`` times."""

    def sort(key: tuple, group: pa.Table) -> pa.Table:
        keys, weights = [], []
        for rows, data in zip(group["rows"].to_pylist(), group["suffixes"].to_pylist()):
            part, n = _unpacked(data, rows)
            keys.append(part.T)
            weights.append(n)
        hot = key[2].as_py()  # the other suffixes of the pair are elsewhere
        found, counts = prefix_counts(np.concatenate(keys), np.concatenate(weights), 1 if hot else least)
        if hot:
            kept = (found[:, -1] == 0) | (counts >= least)  # those of all four words are all here
            found, counts = found[kept], counts[kept]
        arrays = [pa.repeat(key[1], len(counts)), *(pa.array(found[:, i].copy().view(np.int64)) for i in range(LONGEST))]
        return pa.table([*arrays, pa.array(counts)], ["lang", *names, "n"])

    names = [f"h{i}" for i in range(LONGEST)]
    parts = dealt.groupBy("shard", "lang", "hot").applyInArrow(sort, _GRAM)
    summed = parts.groupBy("lang", *names).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    return summed.select("lang", F.filter(F.array(*names), lambda h: h != 0).alias("g"), "a")


# --- scores -----------------------------------------------------------------------------------


def _exact(value) -> Column:
    return value.cast("decimal(20,0)")


def _with_cuts(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with ``l``, ``r`` and ``score`` of the cut that scores lowest."""
    ks = F.sequence(F.lit(1), F.size("g") - 1)
    cuts = found.select("lang", "g", "a", F.explode(ks).alias("k"))
    first = counts.select("lang", F.col("g").alias("first"), F.col("a").alias("l"))
    rest = counts.select("lang", F.col("g").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.withColumns({"first": F.expr("slice(g, 1, k)"), "rest": F.expr("slice(g, k + 1, size(g) - k)")})
    cuts = cuts.join(_small(first), ["lang", "first"]).join(_small(rest), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0))) div cast(l + r as decimal(21,0))")
    lowest = cuts.groupBy("lang", "g", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "g", "a", "cut.l", "cut.r", "cut.score")


def _small(table: DataFrame, most_rows: int = 1 << 18) -> DataFrame:
    """With a broadcast hint if it was counted to be small; a row has four numbers and a language."""
    return F.broadcast(table) if table.count() <= most_rows else table


def _apart(found: DataFrame, percent: int) -> DataFrame:
    """Phrases that are not mostly part of a longer one."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(g) - 1), m -> transform(sequence(1, size(g) - m + 1), i -> slice(g, i, m))))"
    )
    within = found.where(F.size("g") > 2).select("lang", F.explode(inner).alias("g"), F.col("a").alias("outer"))
    most = within.groupBy("lang", "g").agg(F.max("outer").alias("outer"))
    swallowed = 100 * _exact(F.col("outer")) >= percent * _exact(F.col("a"))
    return found.join(most, ["lang", "g"], "left").where(~F.coalesce(swallowed, F.lit(False))).drop("outer")


def _spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with its words as ``phrase``."""
    one = found.select("*", F.posexplode("g").alias("i", "hash"))
    named = one.join(words.select("lang", "hash", "word"), ["lang", "hash"])
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda w: w.word), " ")
    return named.groupBy(*found.columns).agg(spelled.alias("phrase"))


@contextmanager
def _short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is planned inside this sends texts to Python ``rows`` at a time, so that executors hold
    few of them twice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    percent: int = 80,
    top: int | None = None,
    seed: int = 0,
    shard: int = _SHARD,
    block: int = _BLOCK,
) -> DataFrame:
    """``lang``, ``phrase``, its count ``a``, the counts ``l`` and ``r`` of the two parts of the cut that
    scores lowest, the number ``n`` of words of the language and ``score``, for all phrases of two to
    four words that occur ``least`` times and are not mostly (by ``percent``) part of a longer one.
    With ``top``, the first ``top`` of each language, and their ``rank``. ``shard`` is the number of
    pointers that are sorted at once, ``block`` the bytes of text that are read at once; neither
    changes the result."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = docs.select(
        docs[text].cast("string").alias("text"), F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang")
    )
    cut = Cut(seed, block)
    with _short_batches(spark):
        words = saved(word_counts(texts, cut), "phrase-words")
    while clashes(words, least):
        cut = Cut(cut.seed + 1, block)
        with _short_batches(spark):
            words = saved(word_counts(texts, cut), "phrase-words")
    frequent = words.where(F.col("n") >= least)
    known = share(bitmap(frequent, frequent.count()))

    with _short_batches(spark):
        pairs = saved(pair_counts(texts, cut, known).where(F.col("n") >= least), "phrase-pairs")
    n_pairs, pointers = pairs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-pointers // shard))
    often = pairs.where(F.col("n") >= min(shard, pointers // shards + 1) // 8 + least)
    live, hot = share(bitmap(pairs, n_pairs)), share(bitmap(often, often.count()))

    dealt = dealt_suffixes(texts, cut, known, live, hot, shards)
    with _short_batches(spark):
        found = saved(phrase_counts(dealt, least), "phrase-counts")
    for held in (known, live, hot):
        held.unpersist()

    counts = frequent.select("lang", F.array("hash").alias("g"), F.col("n").alias("a")).unionByName(found)
    scored = _with_cuts(_apart(found, percent), counts)
    best = [F.col("score").desc(), F.col("a").desc()]
    if top is not None:
        scored = scored.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*best)))
        scored = scored.where(F.col("_r") <= top).drop("_r")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    columns = ["lang", "phrase", "a", "l", "r", "n", "score"]
    result = _spelled(scored, frequent).join(_small(total), "lang").select(*columns)
    if top is None:
        return result
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))
    return result.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select("lang", "rank", *columns[1:])
