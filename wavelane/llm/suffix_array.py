"""Suffix sorting in linear time by grouping, without recursion or renaming.

First phase: suffixes are grouped by the longest prefix that is a Lyndon word, as far as it is known. Groups
are taken from the largest to the smallest; every member points to the nearest earlier suffix of a smaller
group, and what is pointed at grows its prefix by the group's: it moves to a new group right after its own,
suffixes pointed at more often after those pointed at less often. Second phase: suffixes are emitted in
ascending order; a suffix brings those for which it is the next smaller one, and each takes the next free
place of its group.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers of any size) in ascending order; a suffix that is a
    prefix of another comes first."""
    n = len(text) + 1
    symbols = np.zeros(n, np.int64)
    if n > 1:
        symbols[:-1] = np.unique(text, return_inverse=True)[1].reshape(-1) + 1
    by_symbol = np.argsort(symbols, kind="stable")
    ordered = symbols[by_symbol]
    fresh = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    starts = np.repeat(fresh, np.diff(np.r_[fresh, n]))
    place = by_symbol.tolist()  # suffixes by group
    where = np.empty(n, np.int64)
    where[by_symbol] = np.arange(n)
    where = where.tolist()  # inverse of place
    group = np.empty(n, np.int64)
    group[by_symbol] = starts
    group = group.tolist()  # where a suffix's group begins
    end = [0] * n  # by where a group begins
    for a, b in zip(fresh.tolist(), [*fresh[1:].tolist(), n]):
        end[a] = b
    previous = list(range(-1, n - 1))
    high = n
    while high > 0:
        low = group[place[high - 1]]
        if high - low == 1:
            i = place[low]
            p = i - 1
            while p >= 0 and group[p] > low:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                begin = group[p]
                stop = end[begin]
                if stop - begin > 1:  # p alone becomes a group after its own
                    last = stop - 1
                    other, at = place[last], where[p]
                    place[at], where[other] = other, at
                    place[last], where[p] = p, last
                    group[p] = last
                    end[begin], end[last] = last, stop
        else:
            members = sorted(place[low:high])
            count: dict[int, int] = {}
            for i in members:
                p = i - 1
                while p >= 0 and group[p] >= low:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    count[p] = count.get(p, 0) + 1
            by_count: dict[int, dict[int, list[int]]] = {}
            for p, k in count.items():
                by_count.setdefault(k, {}).setdefault(group[p], []).append(p)
            for k in sorted(by_count, reverse=True):
                for begin, moved in by_count[k].items():
                    stop = end[begin]
                    if len(moved) == stop - begin:
                        continue
                    for p in moved:
                        stop -= 1
                        other, at = place[stop], where[p]
                        place[at], where[other] = other, at
                        place[stop], where[p] = p, stop
                    for p in moved:
                        group[p] = stop
                    end[stop], end[begin] = end[begin], stop
        high = low
    free = list(range(n))
    placed = bytearray(n)
    placed[n - 1] = 1
    place[0] = n - 1
    for at in range(n):
        j = place[at] - 1
        while j >= 0 and not placed[j]:
            begin = group[j]
            place[free[begin]] = j
            free[begin] += 1
            placed[j] = 1
            j = previous[j]
    return np.array(place[1:], np.int64)


def equal_runs(text: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For suffixes in ascending order: the number of the run of neighbours that share ``length`` symbols.
    A suffix shorter than that is a run of its own."""
    if not len(suffixes):
        return np.empty(0, np.int64)
    starts = suffixes[:, None] + np.arange(length)
    inside = starts[:, -1] < len(text)
    heads = text[np.minimum(starts, len(text) - 1)]
    same = (heads[1:] == heads[:-1]).all(axis=1) & inside[1:] & inside[:-1]
    return np.r_[0, np.cumsum(~same)]
