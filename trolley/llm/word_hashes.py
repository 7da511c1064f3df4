"""Hashes of the words of many texts at once, in numpy.

A polynomial over a table of random numbers, modulo 2^64, gives every run of bytes a hash that
follows from sums over the whole buffer, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) at least."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(1 << 20, 1 << max(n - 1, 1).bit_length())
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(factors)
    return known


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the information of all bits over all bits."""
    with np.errstate(over="ignore"):
        h = hashes ^ (hashes >> np.uint64(32))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


class Prefixes:
    """Hashes of any run ``data[start:end]``, by sums up to each place."""

    def __init__(self, values: np.ndarray):
        """``values``: bytes, or numbers of 64 bits that stand for longer units."""
        n = len(values)
        terms = _BYTES[values] if values.dtype == np.uint8 else values.copy()
        terms *= _powers(_BASE, n)[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def of_all(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` values, as ``of`` gives them."""
        found = self.sums[size:] - self.sums[:-size]
        found *= self.inverse[: len(found)]
        return found


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [first, end) of texts of ``size`` bytes together, or of a single longer text: whole
    texts, in pieces that fit the cache."""
    first, n = 0, len(bounds) - 1
    while first < n:
        end = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def runs_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs where ``inside`` holds, none across ``bounds``, and the text
    each belongs to."""
    n = len(inside)
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[bounds[bounds <= n]] = False
    starts = np.flatnonzero(inside & ~before[:n])
    after = np.zeros(n + 1, bool)
    after[:n] = inside
    after[bounds[bounds <= n]] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1
