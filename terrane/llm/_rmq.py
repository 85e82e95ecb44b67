"""Range minima and nearest smaller values of integer arrays, in linear memory."""

from __future__ import annotations

import numpy as np

BLOCK = 16


class RangeMin:
    """Minima of ranges: minima from both ends of each block, and a sparse table over the blocks' minima."""

    def __init__(self, values: np.ndarray):
        blocks = max(1, -(-len(values) // BLOCK))
        self.values = np.full(blocks * BLOCK, np.iinfo(values.dtype).max, values.dtype)
        self.values[: len(values)] = values
        cells = self.values.reshape(blocks, BLOCK)
        self.from_start = np.minimum.accumulate(cells, axis=1).ravel()
        self.to_end = np.ascontiguousarray(np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = np.empty((blocks.bit_length(), blocks), values.dtype)
        self.table[0] = cells.min(axis=1)
        for k in range(1, len(self.table)):  # level k: minima of 2**k blocks
            half = 1 << (k - 1)
            self.table[k] = self.table[k - 1]
            self.table[k, :-half] = np.minimum(self.table[k - 1, :-half], self.table[k - 1, half:])

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The minimum from lo to hi, both included, of each pair; lo <= hi."""
        first, last = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.to_end[lo], self.from_start[hi])
        far = np.flatnonzero(last - first > 1)
        if len(far):
            a, n = first[far] + 1, last[far] - first[far] - 1
            k = np.frexp(n.astype(np.float64))[1] - 1  # the highest power of two within n
            out[far] = np.minimum(out[far], np.minimum(self.table[k, a], self.table[k, a + n - (1 << k)]))
        near = np.flatnonzero(first == last)
        if len(near):
            a, b = lo[near], hi[near]
            found = self.values[a]
            for step in range(1, BLOCK):
                np.minimum(found, self.values[np.minimum(a + step, b)], out=found)
            out[near] = found
        return out


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value, or the length: near ones by steps, far ones by block minima."""
    n, out = len(values), np.full(len(values), len(values), np.int64)
    left = np.arange(n)
    for step in range(1, BLOCK + 1):
        left = left[left + step < n]
        hit = values[left + step] < values[left]
        out[left[hit]] = left[hit] + step
        left = left[~hit]
    if not len(left):
        return out
    mins = RangeMin(values)
    v, block = values[left], (left + BLOCK + 1) // BLOCK  # what has been seen of this block is not smaller
    blocks = mins.table.shape[1]
    for k in reversed(range(len(mins.table))):
        on = block + (1 << k) <= blocks
        on[on] = mins.table[k, block[on]] >= v[on]
        block[on] += 1 << k
    inside = block < blocks
    left, v, block = left[inside], v[inside], block[inside]
    cells = mins.values.reshape(-1, BLOCK)[block] < v[:, None]
    out[left] = block * BLOCK + cells.argmax(axis=1)
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the last one before it with a smaller value, or -1."""
    return len(values) - 1 - next_smaller(values[::-1])[::-1]
