"""FM-index over a sequence of integers, with its occurrence counts in a wavelet matrix.

The sequence is kept as its Burrows-Wheeler transform, one bit vector per bit of its alphabet with
a running count per 64 bits. All operations work on whole arrays of positions at once.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    def __init__(self, values: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (values >> shift & 1).astype(bool)
            self.levels.append((shift, BitVector(ones), int(len(values) - ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the occurrences of ``symbol`` before each position end on the lowest level."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return at


def ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense ranks, from 1, of pairs of ranks."""
    both = left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right
    return np.unique(both, return_inverse=True)[1] + 1


def prefix_ranks(values: np.ndarray, length: int) -> np.ndarray:
    """Dense ranks of the windows of ``length`` values that begin at each place; values are
    positive, and what lies beyond the end is smaller than any value."""
    found, done = values, 1
    while done < length:
        step = min(done, length - done)
        found = ranks(found, np.r_[found[step:], np.zeros(step, found.dtype)])
        done += step
    return found


def _narrow(size: int) -> type:
    """The smaller of two integer types that holds places of a sequence."""
    return np.int32 if size < 1 << 31 else np.int64


class FMIndex:
    """Index of ``values`` (1 to ``alphabet`` - 1) for patterns of at most ``depth`` values.

    Suffixes stand in the order of their first ``depth`` values; equal ones by ``order``, a number
    for every place, so that the first row of a pattern's interval is its first place in that order.
    """

    def __init__(self, values: np.ndarray, alphabet: int, depth: int, order: np.ndarray):
        values, order = np.r_[values, 0], np.r_[order, order.max(initial=0) + 1]  # 0 ends the sequence
        full, short = prefix_ranks(values, depth), prefix_ranks(values, depth - 1)
        self.places = np.lexsort((order, full)).astype(_narrow(len(values)))
        self.bwt = WaveletMatrix(values[self.places - 1], alphabet)
        counts = np.bincount(values, minlength=alphabet)
        begin = np.cumsum(counts) - counts
        symbols = np.arange(alphabet)
        self.base = begin - self.bwt.descend(symbols, np.zeros(alphabet, np.int64))
        # rows whose first depth - 1 values agree, by row
        row = short[self.places]
        begins = np.r_[True, row[1:] != row[:-1]]
        self.blocks = BitVector(begins)
        self.starts = np.r_[np.flatnonzero(begins), len(row)].astype(_narrow(len(values)))
        self.size = len(values)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of ``symbol`` followed by the patterns of the intervals."""
        at = self.bwt.descend(np.r_[symbol, symbol], np.r_[low, high]) + np.r_[self.base[symbol], self.base[symbol]]
        return at[: len(low)], at[len(low) :]

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the first depth - 1 values of the patterns at these rows."""
        block = self.blocks.rank(low + 1)
        return self.starts[block - 1].astype(np.int64), self.starts[block].astype(np.int64)


def _longest(index: FMIndex, values: np.ndarray, at: int, most: int) -> tuple[int, int, int]:
    """Interval and length of the longest match, of ``most`` values at most, that begins at ``at``."""
    for length in range(most, 0, -1):
        low, high = np.array([0]), np.array([index.size])
        for place in range(at + length - 1, at - 1, -1):
            low, high = index.extend(values[place : place + 1], low, high)
            if low[0] >= high[0]:
                break
        else:
            return int(low[0]), int(high[0]), length
    return 0, index.size, 0


def window_intervals(index: FMIndex, values: np.ndarray, begin: np.ndarray, length: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the window of ``depth`` values at each place of the streamed sequences
    ``values[begin : begin + length]``; (0, 0) where no whole window begins.

    The sequences go through the index from right to left, all of them together: a value is put
    before the current match, the interval is reported once ``depth`` values match, and the match
    then loses its last value. Where a match ends, the longest one that begins at the value goes on;
    it is searched anew, which never happens to sequences that the index holds.
    """
    low_of, high_of = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    active = np.searchsorted(-length, -np.arange(length.max(initial=0)), side="left")
    low, high = np.zeros(len(begin), np.int64), np.full(len(begin), index.size, np.int64)
    matched = np.zeros(len(begin), np.int64)
    for step, width in enumerate(active.tolist()):
        at = begin[:width] + length[:width] - 1 - step
        a, b = index.extend(values[at], low[:width], high[:width])
        lost = a >= b
        m = np.where(lost, 0, matched[:width] + 1)
        full = m == depth
        low_of[at[full]], high_of[at[full]] = a[full], b[full]
        if full.any():
            a[full], b[full] = index.shorten(a[full])
            m[full] = depth - 1
        for i in np.flatnonzero(lost):
            a[i], b[i], m[i] = _longest(index, values, int(at[i]), int(matched[i]))
        low[:width], high[:width], matched[:width] = a, b, m
    return low_of, high_of
