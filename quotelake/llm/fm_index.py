"""An FM-index over a shard of word symbols: backward search and location, in numpy.

Symbols are 1..sigma; runs of symbols are parted by separators, which no phrase holds.
The index keeps the last column of the sorted suffixes in a wavelet matrix, whose ranks
drive the search, and every sixteenth text position of the suffix array; the first place
of each run is kept as well, so that a walk to a kept place never crosses a separator.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling. Zeros are separators, smaller than all symbols and
    different from each other by their place; the last symbol is one."""
    n = len(symbols)
    gaps = symbols == 0
    m = int(gaps.sum())
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols.astype(np.int64) + m)
    span, top = 1, int(rank.max(initial=0)) + 1
    while True:
        key = rank * top
        key[:-span] += rank[span:]
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        sorted_key = key[order]
        new[order] = np.cumsum(np.r_[False, sorted_key[1:] != sorted_key[:-1]])
        rank, span, top = new, span * 2, n
        if rank[order[-1]] == n - 1 or span >= n:
            return order


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        values = values.astype(np.int32)
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            sums = np.zeros(len(bit) + 1, np.int32)
            np.cumsum(bit, out=sums[1:])
            self.ones.append(sums)
            self.zeros.append(len(bit) - int(sums[-1]))
            bit = bit.astype(bool)
            values = np.concatenate((values[~bit], values[bit]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        low = np.zeros(len(ends), np.int64)
        high = ends.astype(np.int64)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbols >> (self.bits - 1 - i)) & 1).astype(bool)
            a, b = ones[low], ones[high]
            low = np.where(bit, zeros + a, low - a)
            high = np.where(bit, zeros + b, high - b)
        return high - low


class FMIndex:
    def __init__(self, symbols: np.ndarray, sigma: int):
        """``symbols`` ends with a separator and does not begin with one."""
        n = len(symbols)
        order = suffix_array(symbols)
        before = symbols[order - 1]
        self.size = n
        self.last = before.astype(np.int64)
        self.wavelet = WaveletMatrix(before, max(1, int(sigma).bit_length()))
        self.smaller = np.r_[0, np.cumsum(np.bincount(symbols, minlength=sigma + 1))]
        kept = (order % SAMPLE == 0) | (before == 0)
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.places = order[kept]

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.smaller[symbols] + self.wavelet.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows low..high-1 of the suffixes that begin with each phrase (one per line)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[live, column].astype(np.int64)
            low[live] = self._step(symbols, low[live])
            high[live] = self._step(symbols, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows."""
        rows = rows.copy()
        out = np.empty(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            at = rows[live]
            done = self.kept[at]
            out[live[done]] = self.places[self.kept_before[at[done]]] + steps
            live = live[~done]
            at = rows[live]
            rows[live] = self._step(self.last[at], at)
            steps += 1
        return out
