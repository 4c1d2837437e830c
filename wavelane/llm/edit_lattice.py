"""Least edits that make a list of turns a conversation, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is how many turns are consumed and what the repaired conversation ends with. Turns are
coded by one letter each: ``s``, ``u``, ``a`` for a sound turn whose role begins so, ``o`` for any other role,
the upper-case letter if the turn breaks off, ``x`` if it has to go. An edit is written as its initial: Keep,
Rerole, Delete, Insert. Edits fix what they do (roles alternate), so two different ways from one node to another
never have one's letters as the beginning of the other's if they cost the same; that is why the least letters
of a way are the least letters of its parts, and blocks of turns can be solved on their own.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush

NONE, SYSTEM, USER, ASSISTANT = range(4)  # what a repaired conversation ends with
KEEP_BROKEN, REROLE, DELETE, INSERT = 5, 1, 2, 5
ENDS = (NONE, ASSISTANT)
Way = tuple[int, str]
Node = tuple[int, int]


def _after(state: int) -> int:
    """What an inserted or changed turn makes of a state: a user's turn, or the answer to one."""
    return ASSISTANT if state == USER else USER


def _kept(code: str, state: int) -> int | None:
    """The state after keeping a turn, if it can follow."""
    code = code.lower()
    if code == "s":
        return SYSTEM if state == NONE else None
    return _after(state) if code == ("a" if state == USER else "u") else None


def edges(codes: str) -> tuple[dict[Node, list], dict[Node, list]]:
    """Per node the edits that leave it, and those that lead to it: (other node, cost, letter)."""
    ahead: dict[Node, list] = {(i, s): [] for i in range(len(codes) + 1) for s in range(4)}
    back: dict[Node, list] = {node: [] for node in ahead}
    for (i, state), out in ahead.items():
        out.append(((i, _after(state)), INSERT, "I"))
        if i < len(codes):
            code = codes[i]
            out.append(((i + 1, state), DELETE, "D"))
            if code != "x":
                more = KEEP_BROKEN if code.isupper() else 0
                out.append(((i + 1, _after(state)), REROLE + more, "R"))
                if (kept := _kept(code, state)) is not None:
                    out.append(((i + 1, kept), more, "K"))
        for node, cost, letter in out:
            back[node].append(((i, state), cost, letter))
    return ahead, back


class _Search:
    """One direction: nodes leave the heap by cost, then in the order of the turns, so that all equally cheap
    ways to a node are known when it leaves; of these the least letters stay."""

    def __init__(self, graph: dict[Node, list], origins: list[Node], step: int):
        self.graph, self.step = graph, step
        self.best: dict[Node, Way] = {node: (0, "") for node in origins}
        self.heap = [(0, step * node[0], node) for node in origins]
        self.heap.sort()
        self.done: set[Node] = set()

    def next_cost(self) -> float:
        while self.heap and self.heap[0][2] in self.done:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> Node:
        """Take the nearest node and relax its edges."""
        _, _, node = heappop(self.heap)
        self.done.add(node)
        cost, letters = self.best[node]
        for other, more, letter in self.graph[node]:
            way = (cost + more, letters + letter if self.step > 0 else letter + letters)
            if other not in self.best or way < self.best[other]:
                self.best[other] = way
                heappush(self.heap, (way[0], self.step * other[0], other))
        return node


def least_edits(codes: str, entry: int, exits: tuple[int, ...], graph: tuple[dict, dict] | None = None) -> Way | None:
    """Cost and letters of the cheapest way from ``entry`` before the first turn to one of ``exits`` after the
    last, of equally cheap ones that with the least letters; None if there is no way."""
    ahead, back = graph or edges(codes)
    forward = _Search(ahead, [(0, entry)], 1)
    reverse = _Search(back, [(len(codes), x) for x in exits], -1)
    met = float("inf")
    # Beyond the first meeting, until no crossing of the same cost can be left.
    while (a := forward.next_cost()) + (b := reverse.next_cost()) <= met and min(a, b) < float("inf"):
        side, other = (forward, reverse) if a <= b else (reverse, forward)
        node = side.settle()
        for near in (node, *(x for x, _, _ in side.graph[node])):
            if near in other.best:
                met = min(met, side.best[near][0] + other.best[near][0])
    crossings = [(way[0] + reverse.best[n][0], way[1] + reverse.best[n][1]) for n, way in forward.best.items() if n in reverse.best]
    return min((c for c in crossings if c[0] == met), default=None)


@lru_cache(4096)
def block_ways(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, letters) of a block of a conversation. The first one is entered with nothing, and
    the last one only left where a conversation may end; alone, it has one way."""
    graph = edges(codes)
    entries, exits = [NONE] if first else range(4), [ENDS] if last else [(x,) for x in range(4)]
    return [(e, x[0], *way) for e in entries for x in exits if (way := least_edits(codes, e, x, graph))]


def join_ways(before: dict[int, Way], block: list[tuple[int, int, int, str]]) -> dict[int, Way]:
    """The best ways to each exit of a block, given those to its entries."""
    found: dict[int, Way] = {}
    for entry, end, cost, letters in block:
        if entry in before:
            way = (before[entry][0] + cost, before[entry][1] + letters)
            found[end] = min(found.get(end, way), way)
    return found
