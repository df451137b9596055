"""Run-length grammars by recompression, and longest common extensions answered on them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd

MIX = np.uint64(0x9E3779B97F4A7C15)


class Level(NamedTuple):
    """One step of the compression: which neighbours become one symbol of the next sequence."""

    symbols: np.ndarray  # the sequence before the step
    parent: np.ndarray  # of each symbol, its place in the sequence after the step
    first: np.ndarray  # of each place after the step, that of its first symbol before it; one more at the end
    blocks: bool  # stretches of one symbol, or else pairs
    rules: np.ndarray  # what each name after the step stands for: symbol and power, or left and right + 1 (0: alone)


def _sides(symbols: np.ndarray, step: int) -> np.ndarray:
    """Left (True) or right for each symbol, by a hash of its name; the choice that pairs more neighbours of the two."""
    names = (symbols.astype(np.uint64) + np.uint64(step * 0x10001 + 1)) * MIX
    left = ((names ^ (names >> np.uint64(29))) * MIX >> np.uint64(63)).astype(bool)
    onward = np.count_nonzero(left[:-1] & ~left[1:])
    return left if onward >= np.count_nonzero(~left[:-1] & left[1:]) else ~left


class Grammar:
    """A run-length grammar: block compression and pair compression in turn, until one symbol is left.

    In block compression each stretch of equal symbols becomes a symbol of (symbol, power). In pair compression symbols are
    parted into left and right ones, and each left one with a right one behind it becomes a pair. Equal names of a level
    stand for equal stretches, and equal stretches get equal names but at their borders.
    """

    def __init__(self, symbols: np.ndarray):
        symbols = pd.factorize(np.asarray(symbols, np.int64))[0].astype(np.int32)
        self.size = len(symbols)
        self.levels: list[Level] = []
        step = 0
        while len(symbols) > 1:
            same = symbols[1:] == symbols[:-1]
            if same.any():
                symbols = self._add(symbols, ~same, True)
            step += 1
            if len(symbols) > 1:
                left = _sides(symbols, step)
                paired = left[:-1] & ~left[1:]
                if paired.any():
                    symbols = self._add(symbols, ~paired, False)

    def _add(self, symbols: np.ndarray, begins: np.ndarray, blocks: bool) -> np.ndarray:
        begins = np.concatenate(([True], begins))
        first = np.append(np.flatnonzero(begins), len(symbols)).astype(np.int32)
        held = np.diff(first)
        heads = symbols[first[:-1]].astype(np.int64) << 32
        behind = symbols[np.minimum(first[:-1] + 1, len(symbols) - 1)].astype(np.int64) + 1
        names, rules = pd.factorize(heads | (held if blocks else np.where(held == 2, behind, 0)))
        self.levels.append(Level(symbols, (np.cumsum(begins) - 1).astype(np.int32), first, blocks, rules))
        return names.astype(np.int32)

    def extensions(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from the places ``x`` and ``y`` (never the same) on, both counted, or from there backwards.

        The stretches must end, on either side, before a symbol that occurs once. First the nodes at the two places are
        followed upwards as long as they begin together, with one step aside where they do not; from the first two names
        that differ the way leads down to the first two symbols that do. At most two steps a level, for all places side by side.
        """
        way, origin = (-1 if back else 1), np.asarray(x, np.int64)
        x, y = origin.copy(), np.asarray(y, np.int64).copy()
        differ = np.full(len(x), -1)
        rising = np.arange(len(x))
        for k, level in enumerate(self.levels):
            near, far = (level.first[1:] - 1, level.first[:-1]) if back else (level.first[:-1], level.first[1:] - 1)
            stay, up = rising, []
            while len(stay):
                a, b = x[stay], y[stay]
                pa, pb = level.parent[a], level.parent[b]
                begin = (near[pa] == a) & (near[pb] == b)
                up.append(stay[begin])
                equal = ~begin & (level.symbols[a] == level.symbols[b])
                differ[stay[~begin & ~equal]] = k
                hop = np.minimum(np.abs(far[pa] - a), np.abs(far[pb] - b)) + 1 if level.blocks else np.ones(len(stay), np.int64)
                stay, hop = stay[equal], hop[equal]
                x[stay] += way * hop
                y[stay] += way * hop
            rising = np.concatenate(up) if up else rising
            if not len(rising):
                break
            x[rising], y[rising] = level.parent[x[rising]], level.parent[y[rising]]
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            near = level.first[1:] - 1 if back else level.first[:-1]
            down = np.flatnonzero(differ > k)
            px, py = x[down], y[down]
            a, b = near[px].astype(np.int64), near[py].astype(np.int64)
            held = np.minimum(level.first[px + 1] - level.first[px], level.first[py + 1] - level.first[py]) if level.blocks else 1
            hop = np.where(level.symbols[a] == level.symbols[b], held, 0)
            x[down], y[down] = a + way * hop, b + way * hop
        return np.abs(x - origin)
