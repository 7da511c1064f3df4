"""Keep rows whose key is not stored yet."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key bytes one side may have to be broadcast. The hash relation takes a few times that.
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64


def key_bytes(*columns: str) -> Column:
    """Aggregate: bytes a broadcast of these columns would hold, one entry per row."""
    width = F.lit(_ROW_OVERHEAD).cast("long")
    for name in columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0))


def measured_bytes(keys: DataFrame) -> int:
    """Size of a key frame; one aggregate, one row back."""
    return keys.agg(key_bytes(*keys.columns)).first()[0]


def broadcast_if_small(keys: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keys`` with a broadcast hint if it measures at most ``max_bytes``, else as it came."""
    return F.broadcast(keys) if measured_bytes(keys) <= max_bytes else keys


def new_rows(
    rows: DataFrame,
    stored: DataFrame,
    key: str,
    *,
    strategy: Literal["direct", "semi_first"] = "direct",
    keys: DataFrame | None = None,
    bytes_bound: int | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``rows`` whose ``key`` does not occur in ``stored``; a null key counts as new.

    ``direct`` is the plain anti-join on the key column of ``stored``: Spark broadcasts that
    column where it is small, otherwise both sides are shuffled by key, and AQE splits a
    partition swollen by a hot key.

    ``semi_first`` fits a small batch against a huge table: the batch's keys are broadcast to
    the scan of ``stored`` and only the keys found in both take part in the anti-join, so
    ``stored`` is not shuffled. Their size is checked first: against ``bytes_bound`` if the
    caller knows an upper bound, then by measuring the distinct keys, which evaluates them.
    ``keys`` gives the key column of the batch where it is cheaper to get than from ``rows``.
    Keys over ``max_broadcast_bytes`` fall back to ``direct``.
    """
    if strategy not in ("direct", "semi_first"):
        raise ValueError(f"unknown strategy {strategy!r}")
    known = stored.select(key)
    if strategy == "semi_first":
        keys = (rows if keys is None else keys).select(key)
        small = bytes_bound is not None and bytes_bound <= max_broadcast_bytes
        if not small:
            keys = keys.distinct()
            small = measured_bytes(keys) <= max_broadcast_bytes
        if small:
            # Distinct keys of both sides: no more than the batch keys just checked.
            known = known.join(F.broadcast(keys), key, "left_semi").distinct()
            return rows.join(F.broadcast(known), key, "left_anti")
    return rows.join(known, key, "left_anti")
