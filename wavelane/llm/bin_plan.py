"""Plans for packing counted lengths into bins: linear grouping, configurations, best fit.

The input is how many pieces there are of each length, at most ``capacity`` numbers however many pieces. So is
the plan: runs of bins with equal contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from typing import NamedTuple

import numpy as np


class Slot(NamedTuple):
    """Pieces ``first`` to ``first + count`` (by rank among their length) go ``each`` to a bin, into bins from
    ``bin`` on, side by side from ``offset`` on."""

    length: int
    first: int
    count: int
    each: int
    bin: int
    offset: int


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """The multiset of sizes within the capacity with the largest value: a knapsack, one more item a round."""
    best = np.zeros(capacity + 1)
    taken: list[np.ndarray] = []
    for _ in range(capacity // min(sizes)):
        better, pick = best.copy(), np.full(capacity + 1, -1)
        for g, size in enumerate(sizes):
            value = np.full(capacity + 1, -1.0)
            value[size:] = best[: capacity + 1 - size] + values[g]
            gain = value > better + 1e-12
            better[gain], pick[gain] = value[gain], g
        if (pick < 0).all():
            break
        best = better
        taken.append(pick)
    counts, room = [0] * len(sizes), capacity
    for pick in reversed(taken):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(values @ np.array(counts)), counts


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[list[int], float]]:
    """Configurations and how often to use each (fractions), by column generation: the simplex method over
    configurations, the next one to enter found by a knapsack over the prices of the sizes."""
    k = len(sizes)
    columns = np.zeros((k, k))
    for g, size in enumerate(sizes):
        columns[g, g] = capacity // size
    need = np.array(demand, float)
    for _ in range(rounds):
        inverse = np.linalg.inv(columns)
        use = inverse @ need
        value, entering = _best_configuration(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ np.array(entering, float)
        rising = direction > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, np.maximum(use, 0) / np.where(rising, direction, 1), np.inf)
        columns[:, int(ratio.argmin())] = entering
    use = np.linalg.inv(columns) @ need
    return [([int(round(x)) for x in columns[:, c]], float(use[c])) for c in range(k)]


def plan_bins(counts: dict[int, int], capacity: int, groups: int = 40, large: float = 1 / 7) -> tuple[list[Slot], int]:
    """Slots for all pieces and the number of bins.

    Lengths over ``large`` times the capacity are cut, longest first, into groups of equally many pieces; in a
    group all count as its longest. Configurations of these few sizes are optimised and used a whole number of
    times; each of their places is then given to an actual piece of its group. What rounding down leaves and
    the small pieces go, longest first, where they fit best, or into new bins.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    runs: list[tuple[int, list[tuple[int, int]]]] = []  # (bins, [(length, pieces in each)])
    if capacity in left:
        runs.append((left.pop(capacity), [(capacity, 1)]))
    big = sorted((n for n in left if n > capacity * large), reverse=True)
    total = sum(left[n] for n in big)
    if total:
        queues = _equal_groups([(n, left[n]) for n in big], max(1, -(-total // groups)))
        sizes = [q[0][0] for q in queues]
        demand = [sum(c for _, c in q) for q in queues]
        for counts_of, use in configurations(sizes, demand, capacity):
            places = [g for g, c in enumerate(counts_of) for _ in range(c)]
            wanted = int(use + 1e-6)
            available = [sum(c for _, c in queues[g]) // counts_of[g] for g in set(places)]
            bins = min([wanted, *available])
            if bins > 0 and places:
                runs.extend(_substitute(queues, places, bins))
        for n in big:
            left[n] = 0
        for q in queues:
            for n, c in q:
                left[n] += c
    # Rounding up leaves room in bins. Bins of substituted pieces with more of it than a bound are opened
    # again, and what they held goes best fit with the rest; of several bounds the one with the fewest bins
    # counts, the loosest being to open none.
    bounds = (capacity, capacity // 32, capacity // 128, capacity // 512, 0)
    tries = [_finish(runs, left, capacity, bound) for bound in bounds]
    return _slots(min(tries, key=lambda tried: sum(bins for bins, _ in tried)))


def _finish(runs, left: dict[int, int], capacity: int, bound: int):
    closed, pieces = [], defaultdict(int, left)
    for bins, inside in runs:
        if capacity - sum(n * each for n, each in inside) <= bound:
            closed.append((bins, inside))
        else:
            for n, each in inside:
                pieces[n] += bins * each
    return _best_fit(closed, sorted(((n, c) for n, c in pieces.items() if c), reverse=True), capacity)


def _equal_groups(pieces: list[tuple[int, int]], size: int) -> list[list[tuple[int, int]]]:
    """Cut (length, count) in descending order into groups of ``size`` pieces; groups of one size are one."""
    out: list[list[tuple[int, int]]] = []
    room = 0
    for n, c in pieces:
        while c:
            if room == 0:
                out.append([])
                room = size
            part = min(c, room)
            out[-1].append((n, part))
            c, room = c - part, room - part
    merged: list[list[tuple[int, int]]] = []
    for group in out:
        if merged and merged[-1][0][0] == group[0][0]:
            merged[-1].extend(group)
        else:
            merged.append(group)
    return merged


def _substitute(queues: list[list[tuple[int, int]]], places: list[int], bins: int):
    """Take ``bins`` actual pieces for each place; yields runs of bins with the same lengths."""
    taken = []
    for g in places:
        need, run = bins, []
        while need:
            n, c = queues[g][0]
            part = min(c, need)
            run.append((n, part))
            need -= part
            if part == c:
                queues[g].pop(0)
            else:
                queues[g][0] = (n, c - part)
        taken.append(run)
    at = [0] * len(taken)
    room = [run[0][1] for run in taken]
    done = 0
    while done < bins:
        step = min(room)
        inside: dict[int, int] = defaultdict(int)
        for k, run in enumerate(taken):
            inside[run[at[k]][0]] += 1
        yield step, sorted(inside.items(), reverse=True)
        done += step
        for k, run in enumerate(taken):
            room[k] -= step
            if room[k] == 0 and done < bins:
                at[k] += 1
                room[k] = run[at[k]][1]


def _best_fit(runs, pieces: list[tuple[int, int]], capacity: int):
    """Put (length, count), longest first, into the bins with the least room that suffices."""
    by_room: dict[int, list] = defaultdict(list)
    rooms: list[int] = []

    def add(bins: int, inside: list[tuple[int, int]], room: int) -> None:
        if bins:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append((bins, inside))

    for bins, inside in runs:
        add(bins, inside, capacity - sum(n * each for n, each in inside))
    for n, count in pieces:
        while count:
            k = bisect_left(rooms, n)
            if k == len(rooms):
                bins, inside, room = -(-count // (capacity // n)), [], capacity
            else:
                room = rooms[k]
                bins, inside = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(k)
            each = room // n
            full = min(bins, count // each)
            add(full, [*inside, (n, each)], room - each * n)
            count -= full * each
            rest = bins - full
            if rest and count < each and count:
                add(1, [*inside, (n, count)], room - count * n)
                count, rest = 0, rest - 1
            if inside:
                add(rest, inside, room)
    return [run for room in sorted(by_room) for run in by_room[room]]


def _slots(runs) -> tuple[list[Slot], int]:
    slots, rank, first = [], defaultdict(int), 0
    for bins, inside in runs:
        offset = 0
        for n, each in inside:
            slots.append(Slot(n, rank[n], bins * each, each, first, offset))
            rank[n] += bins * each
            offset += n * each
        first += bins
    return slots, first
