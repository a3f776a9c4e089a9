"""Vectorised words, hashes and shingles over Arrow text batches.

Everything works on the UTF-8 bytes of a slice of rows at once: a 256-entry
table says which bytes belong to words, and a word's 64-bit hash is a polynomial
over its bytes, so no Python object is made for a word.  Slices hold about
``SLICE_BYTES`` of text (one longer text makes a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = np.ones(0, np.uint64)
        self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES)
            inverse = pow(_BASE, -1, 1 << 64)
            steps = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.cumprod(s, dtype=np.uint64) for s in steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def byte_table(is_word, lower: bool = True) -> np.ndarray:
    """Per byte a random 64-bit value, 0 for bytes outside words; A-Z as a-z with ``lower``."""
    rng = np.random.default_rng(20240229)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return np.where(np.array([bool(is_word(b)) for b in range(256)]), values, np.uint64(0))


#: Words are runs of anything but ASCII space and \t \n \v \f \r.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words are runs of letters and digits (every byte of a non-ASCII character counts as a letter).
ALNUM = byte_table(lambda b: b >= 128 or chr(b).isalnum())


def slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last, bytes, row offsets) of consecutive rows; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, buf[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class SortedHashes:
    """Distinct 64-bit hashes, sorted, with an index over their top bits: a vectorised lookup."""

    def __init__(self, hashes: np.ndarray):
        self.keys = np.unique(hashes)
        bits = max(8, min(20, len(self.keys).bit_length() + 2))
        self._shift = np.uint64(64 - bits)
        self._starts = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self._shift).astype(np.int32)
        self._probe = np.append(self.keys, np.uint64(0xFFFFFFFFFFFFFFFF))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the sorted keys, or -1."""
        at = self._starts[hashes >> self._shift]
        key = self._probe[at]
        out = np.where(key == hashes, at, -1)
        left = np.flatnonzero(key < hashes)
        at = at[left]
        while len(left):
            at = at + 1
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            key, want = self.keys[at], hashes[left]
            out[left[key == want]] = at[key == want]
            left, at = left[key < want], at[key < want]
        out[out == len(self.keys)] = -1
        return out


def letters(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table`` at each byte, with Latin-1 signs and general punctuation (U+0080-00BF, U+2000-207F) left out."""
    value = table[buf]
    if (buf >= 128).any():
        two = np.flatnonzero(buf == 0xC2)
        lead = np.flatnonzero(buf == 0xE2)
        lead = lead[(buf[lead + 1] & 0xFE) == 0x80]
        for at, n in ((two, 2), (lead, 3)):
            for j in range(n):
                value[at + j] = 0
    return value


class Words:
    """Words of a slice: ``start`` and ``end`` (bytes), ``hash``, and ``first[r]:first[r+1]`` for row r."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED, signs: bool = True):
        """``signs``: non-ASCII signs and punctuation belong to words too."""
        n = len(buf)
        value = table[buf] if signs else letters(buf, table)
        inside = value != 0
        opens, closes = inside.copy(), inside.copy()
        if n:
            opens[1:] &= ~inside[:-1]
            closes[:-1] &= ~inside[1:]
            edges = offsets[(offsets > 0) & (offsets < n)]
            opens[edges] = inside[edges]
            closes[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        up, down = _POWERS.get(n)
        if len(self.start):
            self.hash = mix64(np.add.reduceat(value * up, self.start) * down[self.start])
        else:
            self.hash = np.zeros(0, np.uint64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values (also across rows; see ``shingles``)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(_BASE)
        out += hashes[j:j + n]
    return mix64(out)


def spans(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the values ``lo[i]:hi[i]`` for each i."""
    up, down = _POWERS.get(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])
    return mix64((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of each row's ``k``-word shingles in order, repeats included.

    A row of fewer than ``k`` words but at least one has its whole sequence as one shingle.
    """
    count = words.counts
    n_of = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    first = np.concatenate([[0], np.cumsum(n_of)])
    out = np.zeros(first[-1], np.uint64)
    rows = np.repeat(np.arange(len(count)), n_of)
    at = words.first[rows] + np.arange(first[-1]) - first[rows]
    long = count[rows] >= k
    out[long] = rolling(words.hash, k)[at[long]]
    for r in np.flatnonzero((count > 0) & (count < k)):
        part = words.hash[words.first[r]:words.first[r + 1]]
        out[first[r]] = rolling(part, len(part))[0] ^ np.uint64(len(part))
    return out, first
