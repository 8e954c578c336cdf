"""Words of whole texts as numpy arrays: many texts at once, no loop over words.

A run of texts is one array of UTF-8 bytes with the offsets of its texts. Words are
maximal runs of word bytes inside one text; each gets a 64-bit hash that depends on its
bytes alone. Sequences of words are hashed from the word hashes in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as are needed."""

    up = _powers(_BASE, 1 << 12)
    down = _powers(_INVERSE, 1 << 12)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > len(cls.up):
            size = 1 << count.bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

# Word bytes: all but the blank and \t \n \v \f \r; the second kind also leaves out
# ASCII signs, and takes letters in lower case.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Run:
    """Whole texts first..first+count-1 of a batch."""

    first: int
    count: int
    data: np.ndarray      # uint8, the texts one after the other
    offsets: np.ndarray   # int64, count + 1


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[Run]:
    """Runs of whole texts of about ``limit`` bytes; null counts as empty. A text longer
    than that is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Run(first, last - first, data[offsets[first]:offsets[last]],
                  offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of a run: byte spans, hashes, the text each belongs to, and bounds[t]:
    bounds[t + 1] are the words of text t."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(run: Run, kind: np.ndarray = SPACED, fold: np.ndarray | None = None,
             hashed: bool = True) -> Words:
    """The words of a run. ``fold`` maps bytes before they are hashed."""
    inside = kind[run.data]
    n = len(inside)
    starts = np.empty(n, bool)
    ends = np.empty(n, bool)
    if n:
        starts[0] = inside[0]
        starts[1:] = inside[1:] & ~inside[:-1]
        ends[-1] = inside[-1]
        ends[:-1] = inside[:-1] & ~inside[1:]
        edges = run.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        starts[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    bounds = np.searchsorted(start, run.offsets)
    if not hashed:
        return Words(start, end, np.zeros(0, np.uint64), bounds)
    values = _BYTE_VALUES[fold[run.data] if fold is not None else run.data]
    return Words(start, end, span_hash(prefix_sums(values), start, end), bounds)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base; entry i covers the values before i."""
    up, _ = _Powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values start..end-1, the same wherever they stand; its length counts."""
    _, down = _Powers.of(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    h ^= (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def gram_hashes(words: Words, size: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``size`` words from each word on; those that leave their text are
    meaningless (see gram_valid)."""
    n = len(words.start)
    sums = prefix_sums(words.hash) if sums is None else sums
    at = np.arange(n)
    return span_hash(sums, at, np.minimum(at + size, n))


def text_of(words: Words) -> np.ndarray:
    """The text (counted in the run) of each word."""
    return np.repeat(np.arange(len(words.bounds) - 1), words.counts)


def gram_valid(words: Words, size: int) -> np.ndarray:
    """Whether ``size`` words from each word on stay in its text."""
    last = np.repeat(words.bounds[1:], words.counts)
    return np.arange(len(words.start)) + size <= last


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each place that has ``width`` values from it on: the place of the smallest of
    them, the last one among equals."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        have += step
    return best
