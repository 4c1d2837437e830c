"""Recompression: a run-length grammar of a string, and longest common extensions on it.

A level replaces each block of one repeated symbol by a symbol, or each pair of a left and a right symbol, after
the alphabet was dealt into left and right ones. Equal stretches are compressed alike but for their edges, so
two positions are compared by rising through the levels as long as they agree and coming down where they part,
one step a level. All of it is done for many positions at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


class Grammar:
    """Levels over ``symbols``: numbers from 0 are letters; a negative one occurs once and is never merged. The
    first and the last symbol must be negative, so that no extension leaves the string."""

    def __init__(self, symbols: np.ndarray, seed: int = 0):
        self.symbols = [symbols.astype(np.int32)]
        self.starts: list[np.ndarray] = []  # of the symbols of level k + 1 in level k, and its length at the end
        self.up: list[np.ndarray] = []  # the symbol of level k + 1 that holds one of level k
        self.blocks: list[bool] = []
        self.pairs: list[bool] = []
        rng = np.random.default_rng(seed)
        least = 4 * int((symbols < 0).sum()) + 16
        while len(self.symbols[-1]) > least:
            self._compress_blocks()
            self._compress_pairs(rng)

    def _add(self, is_start: np.ndarray, names: np.ndarray, blocks: bool) -> None:
        starts = np.flatnonzero(is_start)
        self.up.append((np.cumsum(is_start) - 1).astype(np.int32))
        below = self.symbols[-1][starts]
        self.starts.append(np.r_[starts, len(is_start)].astype(np.int32))
        self.symbols.append(np.where(below < 0, below, pd.factorize(names)[0]).astype(np.int32))
        self.blocks.append(blocks)

    def _compress_blocks(self) -> None:
        now = self.symbols[-1]
        is_start = np.r_[True, now[1:] != now[:-1]]
        if is_start.all():
            return
        starts = np.flatnonzero(is_start)
        lengths = np.diff(np.r_[starts, len(now)])
        self._add(is_start, now[starts] * np.int64(lengths.max() + 1) + lengths, True)

    def _compress_pairs(self, rng: np.random.Generator) -> None:
        now = self.symbols[-1]
        letters = int(now.max(initial=0)) + 1
        side = rng.integers(0, 2, letters).astype(bool)[np.maximum(now, 0)]
        held = now >= 0
        one, other = held & side, held & ~side
        if (one[:-1] & other[1:]).sum() < (other[:-1] & one[1:]).sum():
            one, other = other, one
        second = np.r_[False, one[:-1] & other[1:]]
        if not second.any():
            return
        starts = np.flatnonzero(~second)
        first = now[starts].astype(np.int64)
        paired = np.r_[second, False][starts + 1]
        names = np.where(paired, first * (letters + 1) + now[np.minimum(starts + 1, len(now) - 1)] + 1, first * (letters + 1))
        self._add(~second, names, False)

    def _edge(self, level: int, at: np.ndarray, step: int) -> np.ndarray:
        """How many symbols there are from ``at``, with it, to the end that lies ahead of its own block or pair."""
        above, starts = self.up[level][at], self.starts[level]
        return starts[above + 1] - at if step > 0 else at - starts[above] + 1

    def _enters(self, level: int, at: np.ndarray, step: int) -> np.ndarray:
        """Whether a walk in direction ``step`` that comes to ``at`` there enters a symbol of the level above."""
        above, starts = self.up[level][at], self.starts[level]
        return starts[above] == at if step > 0 else starts[above + 1] - 1 == at

    def _advance(self, level: int, x: np.ndarray, y: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """How far two equal symbols can be passed, and whether what follows is known to differ."""
        if not self.blocks[level]:
            return np.ones(len(x), np.int32), np.zeros(len(x), bool)
        a, b = self._edge(level, x, step), self._edge(level, y, step)
        return np.minimum(a, b), a != b

    def extension(self, x: np.ndarray, y: np.ndarray, step: int = 1) -> np.ndarray:
        """How many symbols from ``x`` on and from ``y`` on are equal, to the right (step 1) or left (-1); in
        no place are both the same."""
        x, y = x.astype(np.int64), y.astype(np.int64)
        origin, top = x.copy(), len(self.starts)
        parted = np.full(len(x), -1)  # the level on which the symbols at x and y differ
        rising = np.arange(len(x))
        for level in range(top):
            a, b, now = x[rising], y[rising], self.symbols[level]
            inside = np.flatnonzero(~(self._enters(level, a, step) & self._enters(level, b, step)))
            p, q = a[inside], b[inside]
            equal = now[p] == now[q]
            parted[rising[inside[~equal]]] = level
            inside, p, q = inside[equal], p[equal], q[equal]
            far, differs = self._advance(level, p, q, step)
            a[inside], b[inside] = p + step * far, q + step * far
            x[rising], y[rising] = a, b
            parted[rising[inside[differs]]] = level
            rising = rising[parted[rising] < 0]
            above, starts = self.up[level], self.starts[level]
            x[rising], y[rising] = above[x[rising]], above[y[rising]]
        now = self.symbols[top]
        parted[rising] = top
        while len(rising):
            rising = rising[now[x[rising]] == now[y[rising]]]
            x[rising] += step
            y[rising] += step
        for level in range(top - 1, -1, -1):
            falling = np.flatnonzero(parted > level)
            starts, now = self.starts[level], self.symbols[level]
            a, b = x[falling], y[falling]
            a, b = (starts[a], starts[b]) if step > 0 else (starts[a + 1] - 1, starts[b + 1] - 1)
            equal = now[a] == now[b]
            far = np.where(equal, self._advance(level, a, b, step)[0], 0)
            x[falling], y[falling] = a + step * far, b + step * far
        return np.abs(x - origin)
