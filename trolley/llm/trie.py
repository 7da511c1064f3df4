"""A compressed trie over ordered sets, probed for sets that overlap enough."""

from __future__ import annotations

import numpy as np


#: Items of a path that a probe takes in one step, before it looks at the bounds again.
_STEP = 128


class SetTrie:
    """Sets of numbers in ascending order, as paths that share their common beginnings.

    ``probe`` walks all paths at once, some items at a time. The overlap of a shared beginning is counted once
    for every set below it; a subtree is left as soon as the lengths that remain on both sides
    cannot bring any of its sets to the similarity.
    """

    def __init__(self, sets: list[np.ndarray], universe: int):
        self.universe = universe
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        lengths = np.array([len(s) for s in sets], np.int64)
        self.flat = np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        lo, hi, parent, start, ends = [0], [0], [-1], [0], [-1]
        stack, previous = [0], None
        for i in order:
            shared = 0 if previous is None else _common(sets[previous], sets[i])
            split = None
            while hi[stack[-1]] > shared:
                split = stack.pop()
            if hi[stack[-1]] < shared:
                lo.append(hi[stack[-1]]), hi.append(shared), parent.append(stack[-1])
                start.append(offsets[previous]), ends.append(-1)
                lo[split], parent[split] = shared, len(lo) - 1
                stack.append(len(lo) - 1)
            lo.append(shared), hi.append(lengths[i]), parent.append(stack[-1])
            start.append(offsets[i]), ends.append(i)
            stack.append(len(lo) - 1)
            previous = i
        self.lo, self.hi, self.parent, self.ends = (np.array(x, np.int64) for x in (lo, hi, parent, ends))
        self.start = np.array(start, np.int64)
        self.shortest = np.where(self.ends >= 0, self.hi, np.iinfo(np.int64).max)
        self.longest = np.where(self.ends >= 0, self.hi, 0)
        for node in np.argsort(-self.hi, kind="stable"):
            up = self.parent[node]
            if up >= 0:
                self.shortest[up] = min(self.shortest[up], self.shortest[node])
                self.longest[up] = max(self.longest[up], self.longest[node])
        self.children = np.argsort(self.parent, kind="stable")[1:]
        self.first_child = np.searchsorted(self.parent[self.children], np.arange(len(lo) + 1))

    def probe(self, items: np.ndarray, percent: int) -> np.ndarray:
        """Sets ``y`` with ``100 * |x & y| >= percent * |x | y|``."""
        member = np.zeros(self.universe, bool)
        member[items] = True
        n = len(items)
        found = []
        nodes = self.children[: self.first_child[1]]
        depths, overlaps = self.lo[nodes], np.zeros(len(nodes), np.int64)
        scale = 100 + percent  # 100 * o >= percent * (n + m - o)
        while len(nodes):
            sizes = np.minimum(self.hi[nodes] - depths, _STEP)
            inside = member[self.flat[_ranges(self.start[nodes] + depths, sizes)]]
            sums, upto = np.concatenate([[0], np.cumsum(inside)]), np.cumsum(sizes)
            overlaps = overlaps + sums[upto] - sums[upto - sizes]
            depths = depths + sizes
            last = self.flat[self.start[nodes] + depths - 1]
            left = np.minimum(n - np.searchsorted(items, last, "right"), self.longest[nodes] - depths)
            done = depths == self.hi[nodes]
            hit = done & (self.ends[nodes] >= 0) & (scale * overlaps >= percent * (n + depths))
            found.append(self.ends[nodes[hit]])
            alive = scale * (overlaps + left) >= percent * (n + self.shortest[nodes])
            within, through = alive & ~done, alive & done
            counts = self.first_child[nodes[through] + 1] - self.first_child[nodes[through]]
            kids = self.children[_ranges(self.first_child[nodes[through]], counts)]
            nodes, depths, overlaps = (
                np.concatenate([nodes[within], kids]),
                np.concatenate([depths[within], self.lo[kids]]),
                np.concatenate([overlaps[within], np.repeat(overlaps[through], counts)]),
            )
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + counts[0] - 1, starts[1] .. and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)
