"""A run-length grammar of a sequence by recompression, and longest common extensions by it.

Two steps alternate until one symbol is left: equal neighbours become a block (symbol and number), then
the alphabet is split in two and each pair of a left and a right symbol becomes one symbol. Symbols are
numbered by their content, so equal symbols of a level stand for equal words. What a symbol covers depends
only on it and its neighbours, so two equal stretches get the same symbols but for their ends; an extension
climbs through levels while both sides stand at a symbol's border and the symbols agree, and comes
down where they don't: a logarithmic number of steps, without suffix arrays.
"""

from __future__ import annotations

import numpy as np

from rollcall.llm.common import mix64


def _number(a: np.ndarray, b: np.ndarray, first: int) -> np.ndarray:
    """Equal pairs get equal numbers, from ``first`` on."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    out = np.empty(len(a), np.int64)
    out[order] = first + np.cumsum(fresh) - 1
    return out


class Grammar:
    """Levels of the grammar over ``ids`` (numbers of words, from 0).

    ``symbols[k]`` is level k; ``first[k]`` has, for each symbol of level k+1, its first child on level k, and the
    end; ``parent[k]`` the parent of each symbol of level k, and the end. ``blocks[k]`` tells whether level k+1 was made of blocks.
    """

    def __init__(self, ids: np.ndarray):
        self.symbols, self.first, self.parent, self.blocks = [ids.astype(np.int64)], [], [], []
        free, turn = int(ids.max(initial=-1)) + 1, 0
        while len(self.symbols[-1]) > 1:
            s = self.symbols[-1]
            head = np.ones(len(s), bool)
            head[1:] = s[1:] != s[:-1]
            if not head.all():
                at = np.flatnonzero(head)
                size = np.diff(np.append(at, len(s)))
                up = s[at].copy()
                many = size > 1
                up[many] = _number(up[many], size[many], free)
                free = max(free, int(up.max()) + 1)
                self._add(up, at, len(s), blocks=True)
                s = up
                if len(s) == 1:
                    break
            joined = self._pairs(s, turn)
            while not joined.any():  # the split left no pair: another one
                turn += 1
                joined = self._pairs(s, turn)
            turn += 1
            head = np.ones(len(s), bool)
            head[1:] = ~joined
            at = np.flatnonzero(head)
            up = s[at].copy()
            left = np.flatnonzero(joined)
            two = np.zeros(len(s), bool)
            two[left] = True
            up[two[at]] = _number(s[left], s[left + 1], free)
            free = max(free, int(up.max()) + 1)
            self._add(up, at, len(s), blocks=False)

    @staticmethod
    def _pairs(s: np.ndarray, turn: int) -> np.ndarray:
        """Where a left symbol is followed by a right one, under the split of this turn or its mirror image."""
        side = (mix64(s.astype(np.uint64) + np.uint64(1 + turn * 0x9E3779B9)) & np.uint64(1)).astype(bool)
        one, other = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        return one if one.sum() >= other.sum() else other

    def _add(self, up: np.ndarray, at: np.ndarray, below: int, blocks: bool) -> None:
        first = np.append(at, below)
        self.symbols.append(up)
        self.first.append(first)
        self.parent.append(np.append(np.repeat(np.arange(len(up)), np.diff(first)), len(up)))
        self.blocks.append(blocks)

    def extend(self, i: int, j: int, back: bool = False) -> int:
        """How many words from ``i`` and from ``j`` on are equal; with ``back`` those before ``i`` and before ``j``."""
        shift = 1 if back else 0
        level, x, y, top = 0, i, j, len(self.first)

        def equal(level: int, x: int, y: int) -> bool:
            s = self.symbols[level]
            inside = min(x, y) > 0 if back else max(x, y) < len(s)
            return inside and s[x - shift] == s[y - shift]

        while True:
            while level < top:
                parent, first = self.parent[level], self.first[level]
                u, v = int(parent[x]), int(parent[y])
                if first[u] != x or first[v] != y or not equal(level + 1, u, v):
                    break
                level, x, y = level + 1, u, v
            if equal(level, x, y):
                k = 1
                if level < top and self.blocks[level]:  # what is left of both blocks of this symbol
                    parent, first = self.parent[level], self.first[level]
                    u, v = int(parent[x - shift]), int(parent[y - shift])
                    k = int(min(x - first[u], y - first[v]) if back else min(first[u + 1] - x, first[v + 1] - y))
                x, y = (x - k, y - k) if back else (x + k, y + k)
            elif level == 0:
                return abs(x - i)
            else:
                level -= 1
                x, y = int(self.first[level][x]), int(self.first[level][y])
