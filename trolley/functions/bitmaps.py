"""Bitmaps of keys that Spark builds and asks itself: a key that was put in is always found, another
one rarely.

A key sets four bits of one chunk of 32,768 bits, so that asking for a key takes one chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 1 << 15
_BITS_PER_KEY, _PLACES = 16, 4


def chunks_for(rows: int) -> int:
    """Chunks, a power of two, that hold ``rows`` keys with some 16 bits for each."""
    full = -(-rows * _BITS_PER_KEY // CHUNK_BITS)
    return 1 << max(0, full - 1).bit_length()


def bucket_of(key: Column | str, buckets: int) -> Column:
    """One of ``buckets``, a power of two; half the keys stay where they are when that doubles."""
    return F.xxhash64(key).bitwiseAND(F.lit(buckets - 1))


def chunk_of(key: Column | str, chunks: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 32).bitwiseAND(F.lit(chunks - 1))


def _places(key: Column | str) -> list[Column]:
    spread = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(spread, 15 * i).bitwiseAND(F.lit(CHUNK_BITS - 1)) for i in range(_PLACES)]


def bitmaps(keys: DataFrame, key: str, buckets: int, chunks: int) -> DataFrame:
    """``bucket``, ``chunk`` and ``bits`` of all keys."""
    bits = keys.select(
        bucket_of(key, buckets).alias("bucket"),
        chunk_of(key, chunks).alias("chunk"),
        F.explode(F.array(*_places(key))).alias("bit"),
    )
    return bits.groupBy("bucket", "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_hold(bits: Column, key: Column | str) -> Column:
    """Whether ``bits``, the chunk of ``key``, has all of its bits."""

    def is_set(place: Column) -> Column:
        byte = F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), place.bitwiseAND(F.lit(7)).cast("int")) == 1

    return reduce(Column.__and__, map(is_set, _places(key)))
