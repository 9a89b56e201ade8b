"""Balanced parentheses of an ordered tree, with range min-max blocks over the excess."""

from __future__ import annotations

import numpy as np

_BLOCK = 64


class Parens:
    """A tree in preorder, one bit a parenthesis (1 opens), packed.

    ``find_close`` looks in the parenthesis' own block, then climbs a tree of block minima of
    the excess to the next block that falls below, and descends to the place in it.  ``leaves``
    ranks leaf pairs, an opening directly before a closing.  All take arrays of places.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.n = len(bits)
        padded = np.zeros(-(-max(self.n, 1) // _BLOCK) * _BLOCK, np.uint8)
        padded[: self.n] = bits
        self._bits = np.packbits(padded.reshape(-1, _BLOCK), axis=1)
        steps = padded.reshape(-1, _BLOCK).astype(np.int64) * 2 - 1
        excess = np.cumsum(steps, axis=1)
        ends = np.cumsum(excess[:, -1])
        self._before = np.concatenate([[0], ends[:-1]])  # excess before each block
        self._lows = [excess.min(axis=1) + self._before]
        while len(self._lows[-1]) > 1:
            low = self._lows[-1]
            if len(low) % 2:
                low = np.append(low, np.iinfo(np.int64).max)
            self._lows.append(low.reshape(-1, 2).min(axis=1))
        leaf = padded.astype(bool)
        leaf[:-1] &= padded[1:] == 0
        if self.n == len(padded):
            leaf[-1] = False
        self._leaf = np.packbits(leaf.reshape(-1, _BLOCK), axis=1)
        self._leaves_before = np.concatenate([[0], np.cumsum(leaf.reshape(-1, _BLOCK).sum(axis=1))])

    def _excess(self, blocks: np.ndarray) -> np.ndarray:
        steps = np.unpackbits(self._bits[blocks], axis=1).astype(np.int64) * 2 - 1
        return np.cumsum(steps, axis=1) + self._before[blocks][:, None]

    def find_close(self, at: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        out = np.empty(len(at), np.int64)
        for i in range(0, len(at), chunk):
            out[i : i + chunk] = self._find_close(at[i : i + chunk])
        return out

    def _find_close(self, at: np.ndarray) -> np.ndarray:
        block, place = at // _BLOCK, at % _BLOCK
        excess = self._excess(block)
        target = excess[np.arange(len(at)), place] - 1
        hit = (excess <= target[:, None]) & (np.arange(_BLOCK) > place[:, None])
        out = block * _BLOCK + hit.argmax(axis=1)
        far = np.flatnonzero(~hit.any(axis=1))
        if not len(far):
            return out
        found = self._next_below(block[far] + 1, target[far])
        hit = self._excess(found) <= target[far][:, None]
        out[far] = found * _BLOCK + hit.argmax(axis=1)
        return out

    def _next_below(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block from ``block`` on whose least excess is at most ``target``."""
        index, level = block.copy(), np.zeros(len(block), np.int64)
        climbing = np.ones(len(block), bool)
        while climbing.any():
            for k, low in enumerate(self._lows):
                mine = np.flatnonzero(climbing & (level == k))
                if not len(mine):
                    continue
                fits = low[index[mine]] <= target[mine]
                climbing[mine[fits]] = False
                on = mine[~fits]
                index[on] += 1
                up = on[index[on] % 2 == 0]
                index[up] //= 2
                level[up] += 1
        for k in range(len(self._lows) - 1, 0, -1):
            mine = np.flatnonzero(level == k)
            left = index[mine] * 2
            index[mine] = left + (self._lows[k - 1][left] > target[mine])
            level[mine] -= 1
        return index

    def leaves(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Leaf pairs that open in ``start <= place < end``."""
        return self._rank(end) - self._rank(start)

    def _rank(self, at: np.ndarray) -> np.ndarray:
        block = at // _BLOCK
        inner = np.unpackbits(self._leaf[np.minimum(block, len(self._leaf) - 1)], axis=1)
        inside = (inner * (np.arange(_BLOCK) < (at % _BLOCK)[:, None])).sum(axis=1)
        return self._leaves_before[block] + inside
