"""A cuckoo filter over 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

from trolley.llm.word_hashes import mix

_SLOTS = 4
_LOAD = 0.85
_KICKS = 64


class CuckooFilter:
    """Fingerprints of 16 bits in two possible buckets of four. Members can be removed again.

    A print that finds no place after ``_KICKS`` moves goes to a small stash with its bucket, so
    that a member is never missed. A full filter is followed by another one (``after``), which takes
    all later members but those that look like one of this filter: what ``remove`` finds first is
    then the print of the member itself, or one that stands for it as well.
    """

    def __init__(self, capacity: int):
        buckets = max(2, int(capacity / _SLOTS / _LOAD))
        self.table = np.zeros((1 << (buckets - 1).bit_length(), _SLOTS), np.uint16)
        self.stash = np.zeros(0, np.int64)
        self.size = 0
        self.after: CuckooFilter | None = None

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        jump = mix(prints.astype(np.uint64)) & np.uint64(len(self.table) - 1)
        return buckets ^ jump.astype(np.int64)

    def _code(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """A print with the lesser of its two buckets."""
        return np.minimum(buckets, self._other(prints, buckets)) << 16 | prints.astype(np.int64)

    def _holds(self, hashes: np.ndarray) -> np.ndarray:
        prints, first = self._places(hashes)
        found = (self.table[first] == prints[:, None]).any(axis=1)
        found |= (self.table[self._other(prints, first)] == prints[:, None]).any(axis=1)
        if len(self.stash):
            found |= np.isin(self._code(prints, first), self.stash)
        return found

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = self._holds(hashes)
        return found | self.after.contains(hashes) if self.after else found

    def _settle(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put prints into free slots of their buckets; tells which found one."""
        order = np.argsort(buckets, kind="stable")
        ranked = buckets[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        first = np.flatnonzero(new)
        rank = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
        free = self.table[ranked] == 0
        slot_rank = np.cumsum(free, axis=1) - 1
        fits = free & (slot_rank == rank[:, None])
        slots = fits.argmax(axis=1)
        placed = fits.any(axis=1)
        self.table[ranked[placed], slots[placed]] = prints[order[placed]]
        done = np.zeros(len(prints), bool)
        done[order[placed]] = True
        return done

    def insert(self, hashes: np.ndarray) -> None:
        """Add the hashes of new members, which may look like those of others."""
        room = 0 if self.after else max(0, int(self.table.size * _LOAD) - self.size)
        self._put(hashes[:room])
        hashes = hashes[room:]
        if len(hashes):
            alike = self._holds(hashes)
            self._put(hashes[alike])
            self.after = self.after or CuckooFilter(max(2 * self.size, len(hashes)))
            self.after.insert(hashes[~alike])

    def _put(self, hashes: np.ndarray) -> None:
        self.size += len(hashes)
        prints, buckets = self._places(hashes)
        for kick in range(_KICKS):
            done = self._settle(prints, buckets)
            prints, buckets = prints[~done], buckets[~done]
            if not len(prints):
                return
            buckets = self._other(prints, buckets)
            if kick:
                # one print per bucket changes places with a stored one, which moves on
                _, chosen = np.unique(buckets, return_index=True)
                slot = (kick + chosen) % _SLOTS
                at = buckets[chosen]
                prints[chosen], self.table[at, slot] = self.table[at, slot].copy(), prints[chosen]
                buckets[chosen] = self._other(prints[chosen], at)
        self.stash = np.concatenate([self.stash, self._code(prints, buckets)])

    def remove(self, hashes: np.ndarray) -> None:
        """Take out members (of each hash one copy)."""
        for value in hashes:
            self._remove(np.array([value], np.uint64))

    def _remove(self, one: np.ndarray) -> None:
        prints, first = self._places(one)
        for bucket in (int(first[0]), int(self._other(prints, first)[0])):
            slots = np.flatnonzero(self.table[bucket] == prints[0])
            if len(slots):
                self.table[bucket, slots[0]] = 0
                self.size -= 1
                return
        at = np.flatnonzero(self.stash == self._code(prints, first)[0])
        if len(at):
            self.stash = np.delete(self.stash, at[0])
            self.size -= 1
        elif self.after:
            self.after._remove(one)
