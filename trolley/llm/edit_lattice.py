"""Cheapest edits of a run of turns, by bidirectional Dijkstra over the lattice of edits.

A node is (turns consumed, state). States say what was emitted last: nothing yet, the system turn,
a user turn, an assistant turn; a conversation may end in the first and the last. Edges are edits:
keep, rerole, delete, insert. Forward and reverse heaps work towards each other and go on until no
crossing as cheap as the best can be missing; of all these crossings, the least audit (the edits'
initials in order) is taken. At one node, audits of equal cost are never prefixes of one another
(it would take a loop of insertions, which costs), so the least forward and the least reverse audit
of a crossing make its least audit.

Costs and audits between all states of a run form a matrix; matrices of neighbouring runs compose,
so a conversation of any length is repaired piece by piece.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)

#: What may be emitted after a state, by initial, and the role that a rerole or an insertion gives.
NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}

#: A turn that may stay is (initial, truncated); a number is so many turns that must go.
Step = tuple[str, bool] | int
Path = tuple[int, str]
Matrix = dict[tuple[int, int], Path]
IDENTITY: Matrix = {(state, state): (0, "") for state in STATES}


def _forward(steps: list[Step], i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges (cost, edits, turns consumed, state) out of a node."""
    yield INSERT, "I", i, GIVEN[state]
    if i == len(steps):
        return
    step = steps[i]
    if isinstance(step, int):
        yield DELETE * step, "D" * step, i + 1, state
        return
    initial, truncated = step
    extra = TRUNCATED * truncated
    yield DELETE, "D", i + 1, state
    yield REROLE + extra, "R", i + 1, GIVEN[state]
    if initial in NEXT[state]:
        yield extra, "K", i + 1, NEXT[state][initial]


def _reverse(steps: list[Step]) -> dict[tuple[int, int], list[tuple[int, str, int, int]]]:
    """Edges into every node, as (cost, edits, turns consumed, state) of where they come from."""
    into: dict[tuple[int, int], list] = {(i, s): [] for i in range(len(steps) + 1) for s in STATES}
    for i, state in list(into):
        for cost, edits, j, after in _forward(steps, i, state):
            into[j, after].append((cost, edits, i, state))
    return into


def search(steps: list[Step], start: int, ends: Iterable[int], into=None) -> Path | None:
    """Cost and least audit of the cheapest edits from ``start`` to one of ``ends``."""
    n, into = len(steps), into or _reverse(steps)
    # Of equal costs, nodes nearer to the heap's own end come first: an edge without cost leads
    # further away, so that all audits of a node are known when it is settled, the least first.
    ahead = [(0, 0, "", 0, start)]
    behind = [(0, 0, "", n, end) for end in ends]
    heapq.heapify(behind)
    left: dict[tuple[int, int], Path] = {}
    right: dict[tuple[int, int], Path] = {}
    best: Path | None = None

    def crossing(before: Path, cost: int, edits: str, after: Path) -> None:
        nonlocal best
        path = (before[0] + cost + after[0], before[1] + edits + after[1])
        if best is None or path < best:
            best = path

    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best[0]):
        if ahead[0][0] <= behind[0][0]:
            cost, _, audit, i, state = heapq.heappop(ahead)
            if (i, state) in left:
                continue
            here = left[i, state] = (cost, audit)
            if (i, state) in right:
                crossing(here, 0, "", right[i, state])
            for more, edits, j, after in _forward(steps, i, state):
                if (j, after) in right:
                    crossing(here, more, edits, right[j, after])
                if (j, after) not in left:
                    heapq.heappush(ahead, (cost + more, j, audit + edits, j, after))
        else:
            cost, _, audit, i, state = heapq.heappop(behind)
            if (i, state) in right:
                continue
            here = right[i, state] = (cost, audit)
            if (i, state) in left:
                crossing(left[i, state], 0, "", here)
            for more, edits, j, before in into[i, state]:
                if (j, before) in left:
                    crossing(left[j, before], more, edits, here)
                if (j, before) not in right:
                    heapq.heappush(behind, (cost + more, n - j, edits + audit, j, before))
    return best


def matrix(steps: list[Step]) -> Matrix:
    """Cheapest edits between all pairs of states."""
    into = _reverse(steps)
    paths = {(s, t): search(steps, s, (t,), into) for s in STATES for t in STATES}
    return {states: path for states, path in paths.items() if path is not None}


def compose(first: Matrix, second: Matrix) -> Matrix:
    """The matrix of two neighbouring runs."""
    made: Matrix = {}
    for (s, middle), (cost, audit) in first.items():
        for t in STATES:
            if (middle, t) in second:
                more, edits = second[middle, t]
                path = (cost + more, audit + edits)
                if (s, t) not in made or path < made[s, t]:
                    made[s, t] = path
    return made


class Run:
    """Matrix of a run that grows at its end. Matrices of as many pieces are composed first, so
    that a long audit is copied only as often as the logarithm of its length."""

    def __init__(self):
        self.pieces: list[tuple[int, Matrix]] = []

    def add(self, piece: Matrix) -> None:
        size = 1
        while self.pieces and self.pieces[-1][0] == size:
            piece, size = compose(self.pieces.pop()[1], piece), 2 * size
        self.pieces.append((size, piece))

    def whole(self) -> Matrix:
        made = None
        for _, piece in reversed(self.pieces):
            made = piece if made is None else compose(piece, made)
        return made or IDENTITY


def repair(whole: Matrix) -> Path:
    """Cost and audit of the cheapest repair of a conversation."""
    return min(whole[START, end] for end in ENDS if (START, end) in whole)
