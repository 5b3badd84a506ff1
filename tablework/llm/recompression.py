"""A run-length grammar by recompression, and longest common extensions in it.

Blocks of equal symbols and pairs of a left and a right symbol are replaced in
turns until little is left. Which symbols are left or right depends on the
symbol alone, so equal stretches are parsed alike except at their ends. An
extension query climbs both places to equal borders level by level, stops where
symbols differ, and descends to the first different symbol; a level costs at
most two comparisons. Many queries take each level together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from tablework.llm import words as W

#: A grammar of more levels than this stops growing; queries then walk its top.
MOST_LEVELS = 80


class Side:
    """The levels as seen in one direction: symbols, the symbol above each, the first one below each."""

    def __init__(self, symbols: list[np.ndarray], above: list[np.ndarray], first: list[np.ndarray], blocks: list[bool]):
        self.symbols, self.above, self.first, self.blocks = symbols, above, first, blocks

    def mirrored(self) -> Side:
        """The same levels from right to left, so that a last symbol becomes a first one."""
        above, first = [], []
        for up, down in zip(self.above, self.first, strict=True):
            above.append((len(down) - 2 - up)[::-1])
            first.append((len(up) - down)[::-1])
        return Side([s[::-1] for s in self.symbols], above, first, self.blocks)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` on and from ``j`` on are equal; i and j differ.

        Both must meet a symbol that occurs once before the array ends.
        """
        a, b = i.astype(np.int64), j.astype(np.int64)
        top = len(self.above)
        level = np.full(len(a), top)
        live = np.arange(len(a))
        for at in range(top):
            if not len(live):
                break
            symbols, up, first = self.symbols[at], self.above[at], self.first[at]
            x, y = a[live], b[live]
            inside = np.flatnonzero((first[up[x]] != x) | (first[up[y]] != y))
            if len(inside):
                u, v = x[inside], y[inside]
                same = symbols[u] == symbols[v]
                if self.blocks[at]:
                    left, right = first[up[u] + 1] - u, first[up[v] + 1] - v
                    step = np.where(same, np.minimum(left, right), 0)
                    stop = ~same | (left != right)
                else:
                    step, stop = same.astype(np.int64), ~same
                x[inside], y[inside] = u + step, v + step
                a[live], b[live] = x, y
                level[live[inside[stop]]] = at
                going = np.ones(len(live), bool)
                going[inside[stop]] = False
                live, x, y = live[going], x[going], y[going]
            a[live], b[live] = up[x], up[y]
        symbols = self.symbols[top]
        while len(live):
            live = live[symbols[a[live]] == symbols[b[live]]]
            a[live] += 1
            b[live] += 1
        for at in range(top - 1, -1, -1):
            low = np.flatnonzero(level > at)
            if not len(low):
                continue
            symbols, first = self.symbols[at], self.first[at]
            k, m = a[low], b[low]
            x, y = first[k].astype(np.int64), first[m].astype(np.int64)
            same = symbols[x] == symbols[y]
            step = np.minimum(first[k + 1] - x, first[m + 1] - y) if self.blocks[at] else 1
            a[low], b[low] = x + same * step, y + same * step
        return a - i


def _blocks(symbols: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts and names of maximal blocks; a block of one symbol keeps its name."""
    start = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    count = np.diff(np.append(start, len(symbols)))
    named = symbols[start].copy()
    many = np.flatnonzero(count > 1)
    if len(many):
        code, names = pd.factorize((named[many].astype(np.int64) << 32) | count[many])
        named[many] = free + code
        free += len(names)
    return start, named, free


def _pairs(symbols: np.ndarray, free: int, turn: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts and names after every left symbol has joined a right one that follows it."""
    seed = np.uint64((turn * int(W.MIX)) & 0xFFFFFFFFFFFFFFFF)
    left = (W.scramble(W.scramble(symbols.astype(np.uint64) * W.MIX + seed)) >> np.uint64(40)) & np.uint64(1) == 1
    pair = np.flatnonzero(left[:-1] & ~left[1:])
    begins = np.ones(len(symbols), bool)
    begins[pair + 1] = False
    start = np.flatnonzero(begins)
    named = symbols[start].copy()
    if len(pair):
        code, names = pd.factorize((symbols[pair].astype(np.int64) << 32) | symbols[pair + 1])
        named[np.searchsorted(start, pair)] = free + code
        free += len(names)
    return start, named, free


def grammar(symbols: np.ndarray, least: int) -> Side:
    """The grammar of an array, up to a level of about ``least`` symbols.

    Symbols are whole numbers from 0 on.
    """
    symbols = symbols.astype(np.int32)
    levels, above, first, blocks = [symbols], [], [], []
    free = int(symbols.max(initial=0)) + 1
    for turn in range(MOST_LEVELS):
        if len(levels[-1]) <= least:
            break
        block = turn % 2 == 0
        start, named, free = _blocks(levels[-1], free) if block else _pairs(levels[-1], free, turn)
        if len(start) == len(levels[-1]):
            continue
        marks = np.zeros(len(levels[-1]), np.int32)
        marks[start] = 1
        above.append(np.cumsum(marks, dtype=np.int32) - 1)
        first.append(np.append(start, len(levels[-1])).astype(np.int32))
        blocks.append(block)
        levels.append(named.astype(np.int32))
    return Side(levels, above, first, blocks)
