"""Token ids in Simple-8b: 64-bit words of a 4-bit selector and 60 bits of ids.

A selector says how many ids of which width its word holds; selector 14 is a run of
240 zeros, and selector 15 is an escape: its payload is the place, in the block's
list of exceptions, of an id that 60 bits can't hold.  Since exceptions lie apart,
every word of a block can be decoded without looking at another.

A shard file is a header, blocks of ``BLOCK_IDS`` ids, then the directory: each
block's byte offset, words, exceptions and ids, and each document's id and number of
ids.  A reader takes the directory from the file's end and decodes blocks whole.
"""

from __future__ import annotations

import struct

import numpy as np

#: Ids and bits of each in a word, by selector.
PACKINGS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ZEROS, ESCAPE = 14, 15
ZERO_RUN = 240
BLOCK_IDS = 1 << 16
MAGIC = b"IDS8B\x01\x00\x00"


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, 61 for those beyond 60."""
    out = np.zeros(len(ids), np.uint8)
    rest = ids.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(shift)
        out[big] += shift
        rest[big] >>= np.uint64(shift)
    out[rest > 0] += 1
    return np.minimum(out, 61)


def _plan(width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(selector, ids taken) of the word that would start at each id: the most ids that fit."""
    n = len(width)
    selector = np.full(n, ESCAPE, np.uint8)
    taken = np.ones(n, np.int64)
    spans = {1: width}  # largest width among the next 1, 2, 4, ... ids
    size = 1
    while size * 2 <= n:
        spans[size * 2] = np.maximum(spans[size][:-size], spans[size][size:])
        size *= 2

    def widest(count: int) -> np.ndarray:
        half = 1 << count.bit_length() - 1
        own = spans[half]
        return own if half == count else np.maximum(own[:n - count + 1], own[count - half:n - half + 1])

    for s in range(len(PACKINGS) - 1, -1, -1):
        count, bits = PACKINGS[s]
        if count <= n:
            fits = np.flatnonzero(widest(count) <= bits)
            selector[fits], taken[fits] = s, count
    if n >= ZERO_RUN:
        fits = np.flatnonzero(widest(ZERO_RUN) == 0)
        selector[fits], taken[fits] = ZEROS, ZERO_RUN
    return selector, taken


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, exceptions) of a block of ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    selector, taken = _plan(_widths(ids))
    starts, at, step, n = [], 0, taken.tolist(), len(ids)
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    used = selector[starts] if len(starts) else np.zeros(0, np.uint8)
    words = used.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(PACKINGS):
        at = np.flatnonzero(used == s)
        if len(at):
            shift = (np.arange(count) * bits).astype(np.uint64)
            words[at] |= np.bitwise_or.reduce(ids[starts[at][:, None] + np.arange(count)] << shift, axis=1)
    at = np.flatnonzero(used == ESCAPE)
    words[at] |= np.arange(len(at), dtype=np.uint64)
    return words, ids[starts[at]]


def decode(words: np.ndarray, exceptions: np.ndarray) -> np.ndarray:
    """The ids of a block, all words of a selector at once."""
    used = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in PACKINGS] + [ZERO_RUN, 1])[used]
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(first[-1], np.uint64)
    for s, (count, bits) in enumerate(PACKINGS):
        at = np.flatnonzero(used == s)
        if len(at):
            shift = (np.arange(count) * bits).astype(np.uint64)
            out[first[at][:, None] + np.arange(count)] = (words[at][:, None] >> shift) & np.uint64((1 << bits) - 1)
    at = np.flatnonzero(used == ESCAPE)
    if len(at):
        out[first[at]] = exceptions[(words[at] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def write_shard(sink, doc_ids: list[int | None], counts: list[int], ids: np.ndarray, block_ids: int = BLOCK_IDS) -> None:
    """One shard file of documents' ids, one after the other."""
    sink.write(MAGIC)
    at, blocks = len(MAGIC), []
    for lo in range(0, len(ids), block_ids):
        part = ids[lo:lo + block_ids]
        words, exceptions = encode(part)
        sink.write(words.astype("<u8").tobytes() + exceptions.astype("<u8").tobytes())
        blocks.append((at, len(words), len(exceptions), len(part)))
        at += 8 * (len(words) + len(exceptions))
    sink.write(np.array(blocks, "<i8").tobytes())
    sink.write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    sink.write(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    sink.write(np.array(counts, "<i8").tobytes())
    sink.write(struct.pack("<qqq", at, len(blocks), len(doc_ids)) + MAGIC)


class Shard:
    """A shard file opened for reading: ``doc_ids``, ``counts``, and ids by block or by range."""

    def __init__(self, file):
        self._file, size = file, file.size()
        at, n_blocks, n_docs = struct.unpack("<qqq", file.read_at(24, size - 24 - len(MAGIC)))
        tail = file.read_at(size - at, at)
        if tail[-len(MAGIC):] != MAGIC:
            raise ValueError("not a shard file")
        self.blocks = np.frombuffer(tail, "<i8", 4 * n_blocks).reshape(-1, 4)
        at = 32 * n_blocks
        ids = np.frombuffer(tail, "<i8", n_docs, at).tolist()
        nulls = np.frombuffer(tail, np.uint8, n_docs, at + 8 * n_docs).tolist()
        self.doc_ids = [None if null else d for d, null in zip(ids, nulls)]
        self.counts = np.frombuffer(tail, "<i8", n_docs, at + 9 * n_docs)
        self._held: tuple[int, np.ndarray] | None = None

    def block(self, i: int) -> np.ndarray:
        if self._held is None or self._held[0] != i:
            at, n_words, n_exceptions, n_ids = self.blocks[i].tolist()
            data = np.frombuffer(self._file.read_at(8 * (n_words + n_exceptions), at), "<u8")
            ids = decode(data[:n_words], data[n_words:])
            if len(ids) != n_ids:
                raise ValueError(f"block {i} has {len(ids)} ids, not {n_ids}")
            self._held = i, ids
        return self._held[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the shard, decoding only the blocks that hold them."""
        first = np.concatenate([[0], np.cumsum(self.blocks[:, 3])])
        out = []
        i = int(np.searchsorted(first, start, "right")) - 1
        while n > 0:
            own = self.block(i)[start - first[i]:start - first[i] + n]
            out.append(own)
            start, n, i = start + len(own), n - len(own), i + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint64)
