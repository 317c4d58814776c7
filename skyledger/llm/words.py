"""Words, hashes and shingles of whole Arrow batches of texts, as numpy arrays.

A word is a maximal run of bytes that are no separators. The default separators are space and 0x09-0x0D, all of
them ASCII, so runs of UTF-8 bytes and runs of code points are the same. Null texts have no words.

All functions work on a bounded piece of a batch (``pieces``), so memory does not follow the size of a batch. One
text longer than a piece is a piece of its own; its words are hashed in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21
BLOCK = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither a letter nor a digit.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    data: np.ndarray  # bytes of all rows
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    row: np.ndarray  # row of each word
    offsets: np.ndarray  # bytes of row r: offsets[r] to offsets[r + 1]

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def first_of_row(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes together."""
    size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if len(size):
        group = np.cumsum(size, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, np.flatnonzero(ends) + 1, row, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a bijection on 64 bits)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, _U)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for sorted ranges, whatever their place.

    Prefix sums of value times base**place; a range's difference is moved to place 0 by the inverse base.
    """
    out = np.empty(len(start), _U)
    a = 0
    while a < len(start):
        first = int(start[a])
        b = max(a + 1, int(np.searchsorted(start, first + BLOCK)))
        last = int(end[a:b].max())
        n = last - first
        sums = np.zeros(n + 1, _U)
        np.cumsum((values[first:last].astype(_U) + _U(1)) * _powers(_BASE, n), out=sums[1:])
        s, e = start[a:b] - first, end[a:b] - first
        out[a:b] = mix((sums[e] - sums[s]) * _powers(_INVERSE, n + 1)[s] + (e - s).astype(_U))
        a = b
    return out


def word_hashes(words: Words) -> np.ndarray:
    return range_hashes(words.data, words.start, words.end)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted by row and hash: (row, hash, n of each row).

    A row with 1 to k - 1 words has its whole sequence as its one shingle; a row without words has none.
    """
    h = word_hashes(words)
    count, first = words.per_row(), words.first_of_row()[:-1]
    at = np.flatnonzero(words.row[k - 1 :] == words.row[: len(h) - k + 1]) if len(h) >= k else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    start = np.concatenate([at, first[short]])
    end = np.concatenate([at + k, first[short] + count[short]])
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    row, key = words.row[start], range_hashes(h, start, end)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    row, key = row[fresh], key[fresh]
    return row, key, np.bincount(row, minlength=words.rows)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
