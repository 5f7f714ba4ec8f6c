"""Words of Arrow text columns as hashes, in numpy.

Texts stay in the Arrow buffer.  A table is worked off in pieces of about a
megabyte, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: bytes of text that are worked on at once; a longer text is a piece of its own
PIECE = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240607))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = (_random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[LOWER]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: everything in ASCII but letters and digits separates
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(i).isalnum() for i in range(128)]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes: every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


@dataclass
class Piece:
    """Rows ``first ..`` of a column: word hashes, their bounds per row and the bytes of each word."""

    first: int
    words: np.ndarray    # uint64, one per word
    bounds: np.ndarray   # row r has words bounds[r] : bounds[r + 1]
    starts: np.ndarray   # of each word in data
    ends: np.ndarray
    data: np.ndarray     # original bytes
    offsets: np.ndarray  # of the rows in data
    sums: np.ndarray     # running sum of what the bytes of words add to hashes
    inner: np.ndarray    # where each word begins in sums

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def beginnings(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word; 0 for words that are no longer."""
        longer = self.ends - self.starts > size
        out = np.zeros(len(self.words), np.uint64)
        at = self.inner[longer]
        out[longer] = mix(self.sums[at + size] - self.sums[at] + np.uint64(size << 32))
        return out


def _words(data: np.ndarray, offsets: np.ndarray, first: int, blank: np.ndarray) -> Piece:
    word = ~blank[data]
    begins = np.empty(len(data), bool)
    begins[:1] = True
    np.logical_not(word[:-1], out=begins[1:])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins &= word
    at = np.flatnonzero(word)
    inner = np.flatnonzero(begins[at])
    starts = at[inner]
    lengths = np.diff(inner, append=len(at))
    place = np.arange(len(at)) - np.repeat(inner, lengths)
    power = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, _STEP))
    sums = np.zeros(len(at) + 1, np.uint64)
    np.cumsum(_VALUE[data[at]] * power[place], out=sums[1:])
    hashes = sums[inner + lengths] - sums[inner]
    return Piece(first, mix(hashes + lengths.astype(np.uint64)), np.searchsorted(starts, offsets), starts, starts + lengths,
                 data, offsets, sums, inner)


def pieces(column: pa.Array, size: int = PIECE, blank: np.ndarray = BLANK) -> Iterator[Piece]:
    data, offsets = buffer(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        part = offsets[first:last + 1]
        yield _words(data[part[0]:part[-1]], part - part[0], first, blank)
        first = last


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words, but not none, are one run."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    run = min(n, size)
    h = np.full(n - run + 1, np.uint64(run))
    for j in range(run):
        h = h * _STEP + words[j:n - run + 1 + j]
    return np.unique(mix(h))
