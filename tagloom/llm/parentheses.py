"""A forest as balanced parentheses, with range minima over blocks of its excess.

Node i is the i-th opening bracket. The excess before a place is how many brackets are open there.
``find_close`` looks through the rest of a bracket's block, then climbs a tree of the blocks' minima,
then looks through one more block, for many brackets at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256


class Parentheses:
    def __init__(self, opens: np.ndarray) -> None:
        """``opens``: for each bracket whether it opens. Every bracket must have its partner."""
        self.opens = opens
        self.places = np.flatnonzero(opens)  # select: where node i opens
        steps = np.where(opens, 1, -1).astype(np.int32)
        self.excess = np.cumsum(steps, dtype=np.int32)  # after each bracket
        self.rank = np.concatenate([[0], np.cumsum(opens)])  # opening brackets before a place
        pairs = np.zeros(len(opens) + 1, dtype=np.int64)
        pairs[1:-1] = opens[:-1] & ~opens[1:]
        self.leaf_pairs = np.cumsum(pairs)  # pairs () that begin before a place less one
        blocks = max(1, -(-len(opens) // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        self.leaves = 1 << (blocks - 1).bit_length()
        self.minima = np.full(2 * self.leaves, np.iinfo(np.int32).max, dtype=np.int32)
        self.minima[self.leaves : self.leaves + blocks] = self.blocks.min(axis=1)
        level = self.leaves
        while level > 1:
            half = level // 2
            self.minima[half:level] = np.minimum(self.minima[level : 2 * level : 2], self.minima[level + 1 : 2 * level : 2])
            level = half

    def _first_in_block(self, block: np.ndarray, least: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The first place from ``least`` on in a block with excess ``wanted`` or lower, else -1."""
        out = np.empty(len(block), dtype=np.int64)
        for low in range(0, len(block), 1 << 12):  # a bounded table of blocks at a time
            part = slice(low, low + (1 << 12))
            fits = self.blocks[block[part]] <= wanted[part, None]
            fits &= np.arange(BLOCK) >= (least[part] - block[part] * BLOCK)[:, None]
            at = fits.argmax(axis=1)
            out[part] = np.where(fits[np.arange(len(at)), at], block[part] * BLOCK + at, -1)
        return out

    def find_close(self, nodes: np.ndarray) -> np.ndarray:
        """Where the brackets that open ``nodes`` are closed."""
        opened = self.places[nodes]
        wanted = self.excess[opened] - 1
        close = self._first_in_block(opened // BLOCK, opened + 1, wanted)
        far = np.flatnonzero(close < 0)
        if len(far):
            close[far] = self._beyond(opened[far] // BLOCK, wanted[far])
        return close

    def _beyond(self, block: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = block + self.leaves
        climbing = np.ones(len(at), dtype=bool)
        while climbing.any():  # up, until a block range to the right goes low enough
            right = np.where(at % 2 == 0, at + 1, 1)
            found = climbing & (at % 2 == 0) & (self.minima[right] <= wanted)
            at = np.where(found, right, np.where(climbing, at // 2, at))
            climbing &= ~found
        while (inner := at < self.leaves).any():  # down to its first block that does
            left = np.where(inner, 2 * at, at)
            at = np.where(inner & (self.minima[left] > wanted), left + 1, left)
        block = at - self.leaves
        return self._first_in_block(block, block * BLOCK, wanted)

    def subtree_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """For each node, the node after its subtree, and how many leaf pairs its subtree has."""
        close = self.find_close(np.arange(len(self.places)))
        return self.rank[close], self.leaf_pairs[close] - self.leaf_pairs[self.places]

    def depths(self) -> np.ndarray:
        return self.excess[self.places] - 1

    def parents(self) -> np.ndarray:
        """Each node's parent: the last node before it that is one less deep; -1 for roots."""
        depth, n = self.depths().astype(np.int64), len(self.places)
        keys = depth * n + np.arange(n)
        order = np.argsort(keys)
        before = np.searchsorted(keys[order], keys - n) - 1
        return np.where(depth > 0, order[before], -1)


class RangeMinimum:
    """The least of any run of values, from the minima of all runs whose lengths are powers of 2."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 * (step := 1 << (len(self.levels) - 1)) <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Least of ``values[begin:end]``; no run may be empty."""
        out = np.empty(len(begin), dtype=self.levels[0].dtype)
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        for k, minima in enumerate(self.levels):
            some = np.flatnonzero(level == k)
            out[some] = np.minimum(minima[begin[some]], minima[end[some] - (1 << k)])
        return out
