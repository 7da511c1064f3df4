"""Counts of the beginnings of short suffixes, by multikey three-way quicksort.

Pointers into a table of suffixes are split by their key at some depth into smaller, equal and
larger ones than a pivot. The weight of an equal part is the count of its prefix, and it goes on one
key deeper; parts lighter than what is asked for are abandoned, whatever they hold. All parts of a
round are split at once, in numpy.
"""

from __future__ import annotations

import numpy as np


def prefix_counts(
    keys: np.ndarray, weights: np.ndarray, least: int, shortest: int = 2
) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of at least ``shortest`` keys whose weight is ``least`` or more, as rows of the width
    of ``keys`` with 0 behind their end, and their weights. A key of 0 ends a row of ``keys``."""
    width = keys.shape[1]
    chance = np.random.default_rng(1)
    pointers = np.arange(len(keys))
    sizes, depths = np.array([len(keys)]), np.array([0])
    found, counts = [np.zeros((0, width), keys.dtype)], [np.zeros(0, np.int64)]
    while len(pointers):
        starts = np.cumsum(sizes) - sizes
        heavy = np.add.reduceat(weights[pointers], starts) >= least
        if not heavy.all():
            pointers = pointers[np.repeat(heavy, sizes)]
            sizes, depths = sizes[heavy], depths[heavy]
            if not len(pointers):
                break
            starts = np.cumsum(sizes) - sizes
        parts = np.repeat(np.arange(len(sizes)), sizes)
        chosen = pointers[starts + (chance.random(len(sizes)) * sizes).astype(np.int64)]
        pivots = keys[chosen, depths]
        own = keys[pointers, depths[parts]]
        against = pivots[parts]
        side = 1 + (own > against).astype(np.int8) - (own < against)

        # places of a stable partition: where each part's side begins, and the rank within it
        split = np.bincount(parts * 3 + side, minlength=3 * len(sizes))
        begins = np.cumsum(split) - split
        moved = np.empty_like(pointers)
        for kind in range(3):
            mine = np.flatnonzero(side == kind)
            of = parts[mine]
            per_part = split[kind::3]
            moved[begins[kind::3][of] + np.arange(len(mine)) - (np.cumsum(per_part) - per_part)[of]] = pointers[mine]

        equal = np.add.reduceat(np.where(side == 1, weights[pointers], 0), starts)
        kept = (pivots != 0) & (depths + 1 >= shortest) & (equal >= least)
        if kept.any():
            rows = keys[chosen[kept]].copy()
            rows[np.arange(width) > depths[kept][:, None]] = 0
            found.append(rows)
            counts.append(equal[kept])

        depths = np.repeat(depths, 3)
        depths[1::3] += 1
        goes_on = split > 0
        goes_on[1::3] &= (pivots != 0) & (depths[1::3] < width)
        pointers = moved[np.repeat(goes_on, split)]
        sizes, depths = split[goes_on], depths[goes_on]
    return np.concatenate(found), np.concatenate(counts)
