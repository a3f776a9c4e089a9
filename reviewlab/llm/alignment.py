"""Alignment of two tokenizers' tokens over whole texts, and corpus-wide counts of aligned id pairs.

A text is encoded by a byte-level BPE (side A, with a space before it) and by a sentencepiece model
(side B, which adds that space itself).  Both sides' tokens cover the same bytes, so the places
where a token of either side ends cut the text into segments, each of one A and one B token:
the segments are the *links*, and the places where both end part the *groups*.

Counting pairs is external.  A task gathers links of whole documents up to ``LINKS``, sorts them side-major (B
id, then A id, then document) and writes them, radix-partitioned by the pair's hash, as zstd runs:
each pair once with its number of links, and beside it the documents that have it.  A merge task walks
the runs of one radix by a k-way heap over their blocks' last pairs, adds up each pair, and, as
side-major order brings a B id's pairs together, its highest count; while it walks, every
run's totals stream back in that run's own order.  Documents never leave their runs until the totals
come back, so a pair or an id that holds any share of all links is one entry a run.  The highest
count of each B id over all radixes is a table of the vocabulary's size.

Runs are tables in the shared folder; a lost task or executor repeats what isn't committed.  A merge
holds a block of each run and spills whole runs beyond ``HELD`` bytes into an unnamed local file
of the task's own.

Defined results: null and empty texts, and texts whose tokens' bytes differ from space and text on either
side (a literal U+2581, for instance), have no tokens: zeros and an empty ``groups_sha256``.  Special
tokens' strings are plain text.  A very long text is one run of its own; repeated rows and equal
ids each have a row; extra columns aren't read; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import stash
from reviewlab.llm.textkernel import mix64
from reviewlab.llm.workercache import kept

#: Links that a task gathers before it writes runs.
LINKS = 3 << 20
#: Bytes of text that are aligned at once.
SLICE_BYTES = 1 << 20
#: Pairs of a compressed block.
BLOCK = 1 << 14
#: Bytes of runs that a merge keeps in memory before the others go to its local file.
HELD = 64 << 20
A_BITS = 32


class Side:
    """A tokenizer: its ids' bytes."""

    def __init__(self, pieces: list[bytes], encode):
        self.encode = encode
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.bytes = pa.array(pieces, pa.large_binary())

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, one after the other."""
        taken = self.bytes.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int64)
        return taken.buffers()[2].to_pybytes()[ends[taken.offset]:ends[taken.offset + len(ids)]]


def byte_side(path: str) -> Side:
    """Side A from a byte-level BPE's tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    from reviewlab.llm.bpe import PATTERN, Bpe
    own = Bpe(path)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = True
    special = set(own.special.values())
    ranks = {b: i for i, b in enumerate(own.bytes_of) if i not in special and b}
    # ids that follow the order of merges are ranks, which the faster library takes as they are
    if _ids_are_ranks(own):
        import tiktoken
        fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(own.bytes_of, lambda texts: [fast.encode_ordinary(t) for t in texts])
    return Side(own.bytes_of, lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)])


def _ids_are_ranks(own) -> bool:
    return all(i < 256 for i in own.byte_ids) and own.merged == list(range(256, 256 + len(own.merged)))


def piece_side(path: str) -> Side:
    """Side B from a sentencepiece model."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(pieces, lambda texts: model.encode(texts, num_threads=1))


class Decimals:
    """Decimal ids followed by a sign, as one Arrow array a side: taking from it joins text without Python strings."""

    def __init__(self, n_a: int, n_b: int):
        texts = [f"{i}{sign}".encode() for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs for i in range(n)]
        self.texts = pa.array(texts, pa.large_binary())
        self.at = {("a", 0): 0, ("a", 1): n_a, ("b", 0): 2 * n_a, ("b", 1): 2 * n_a + n_b}


@dataclass
class Aligned:
    """Links and counts of some documents: a, b and doc of every link, and per document the rest."""
    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups_sha256: list[str]


class Aligner:
    """Both sides of an alignment."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.decimals = Decimals(len(a.lengths), len(b.lengths))

    def _fitting(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """The rows whose tokens cover space and text on both sides, and their ids."""
        rows = [i for i, t in enumerate(texts) if t]
        own = [texts[i] for i in rows]
        raws = [b" " + t.encode() for t in own]
        a_ids, b_ids = ([np.array(x, np.int64) for x in side] for side in (self.a.encode([" " + t for t in own]), self.b.encode(own)))
        fits = [len(raw) == self.a.lengths[a].sum() == self.b.lengths[b].sum() for raw, a, b in zip(raws, a_ids, b_ids)]
        if not all(fits) or not self._same(a_ids, b_ids, raws):
            # some text differs: each is looked at by itself
            fits = [ok and self._same([a], [b], [raw]) for ok, a, b, raw in zip(fits, a_ids, b_ids, raws)]
        return tuple([x for x, ok in zip(column, fits) if ok] for column in (rows, a_ids, b_ids))

    def _same(self, a_ids: list[np.ndarray], b_ids: list[np.ndarray], raws: list[bytes]) -> bool:
        raw = b"".join(raws)
        return not raws or self.a.joined(np.concatenate(a_ids)) == raw == self.b.joined(np.concatenate(b_ids))

    def align(self, texts: list[str | None]) -> Aligned:
        n = len(texts)
        rows, a_ids, b_ids = self._fitting(texts)
        n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
        digests = [""] * n
        if not rows:
            none = np.zeros(0, np.int64)
            return Aligned(none, none, none, n_a, n_b, n_groups, n_links, digests)
        n_a[rows], n_b[rows] = [len(x) for x in a_ids], [len(x) for x in b_ids]
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        text_ends = a_ends[np.cumsum(n_a[rows]) - 1]
        # which sides end at each byte: 1, 2 or both
        mark = np.zeros(a_ends[-1] + 1, np.uint8)
        mark[a_ends] = 1
        mark[b_ends] |= 2
        ends = np.flatnonzero(mark)
        mark = mark[ends]
        a_end, b_end, both = (mark & 1) != 0, (mark & 2) != 0, mark == 3
        link_a, link_b = np.cumsum(a_end) - a_end, np.cumsum(b_end) - b_end
        upto = np.searchsorted(ends, text_ends, "right")
        n_links[rows] = np.diff(upto, prepend=0)
        groups = np.cumsum(both)
        n_groups[rows] = np.diff(groups[upto - 1], prepend=0)
        group = groups - both
        for row, digest in zip(rows, self._digests(a, b, group[a_end], group[b_end], both[a_end], both[b_end], n_a[rows] + n_b[rows])):
            digests[row] = digest
        return Aligned(a[link_a], b[link_b], np.repeat(rows, n_links[rows]), n_a, n_b, n_groups, n_links, digests)

    def _digests(self, a, b, a_group, b_group, a_last, b_last, tokens) -> Iterator[str]:
        """Each text's groups as decimal ids, hashed."""
        d = self.decimals
        a_in, b_in = np.bincount(a_group), np.bincount(b_group)
        place = np.empty(len(a) + len(b), np.int64)
        codes = np.concatenate([np.where(a_last, d.at["a", 1], d.at["a", 0]) + a, np.where(b_last, d.at["b", 1], d.at["b", 0]) + b])
        place[:len(a)] = np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]
        place[len(a):] = np.arange(len(b)) + np.cumsum(a_in)[b_group]
        ordered = np.empty_like(codes)
        ordered[place] = codes
        text = d.texts.take(pa.array(ordered))
        offsets, data = np.frombuffer(text.buffers()[1], np.int64), memoryview(text.buffers()[2])
        at = 0
        for n in tokens.tolist():
            yield hashlib.sha256(data[offsets[at]:offsets[at + n] - 1]).hexdigest()
            at += n


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as zstd frames of their bytes, each behind its length."""
    out = []
    for x in arrays:
        frame = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())
        out += [len(frame).to_bytes(8, "little"), frame]
    return b"".join(out)


def _unpacked(blob: bytes, *dtypes) -> list[np.ndarray]:
    out, at = [], 0
    for dtype in dtypes:
        n = int.from_bytes(blob[at:at + 8], "little")
        out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at + 8:at + 8 + n]), dtype))
        at += 8 + n
    return out


def _grouped(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def _blocks(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs and their numbers of links as compressed blocks: differences, then counts."""
    out = []
    for at in range(0, len(keys), BLOCK):
        own = keys[at:at + BLOCK]
        out.append(_packed(np.append(own[:1], np.diff(own)), counts[at:at + BLOCK]))
    sizes = np.array([len(x) for x in out], "<u8")
    return len(out).to_bytes(8, "little") + sizes.tobytes() + b"".join(out)


class Run:
    """A run's blocks, read one after the other from memory or from the task's file."""

    def __init__(self, chunk: int, blob: bytes, spill: Spill):
        self.chunk = chunk
        n = int.from_bytes(blob[:8], "little")
        self._sizes = np.frombuffer(blob, "<u8", n, 8).tolist()
        self._body = spill.keep(blob, 8 + 8 * n)
        self._at = self._next = 0
        self.keys = self.counts = np.zeros(0, np.uint64)
        self.totals: list[np.ndarray] = []

    def load(self) -> bool:
        """The next block, behind what is left of this one; False at the end."""
        if self._next == len(self._sizes):
            return False
        size = self._sizes[self._next]
        steps, counts = _unpacked(self._body.read(self._at, size), "<u8", "<u8")
        self._at, self._next = self._at + size, self._next + 1
        self.keys = np.concatenate([self.keys, np.cumsum(steps, dtype=np.uint64)])
        self.counts = np.concatenate([self.counts, counts])
        return True

    def take(self, upto: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Pairs up to ``upto``, removed."""
        n = int(np.searchsorted(self.keys, upto, "right"))
        out = self.keys[:n], self.counts[:n]
        self.keys, self.counts = self.keys[n:], self.counts[n:]
        return out


class _Held:
    def __init__(self, blob: bytes, start: int):
        self._blob, self._start = blob, start

    def read(self, at: int, size: int) -> bytes:
        return self._blob[self._start + at:self._start + at + size]


class _Filed:
    def __init__(self, file, start: int):
        self._file, self._start = file, start

    def read(self, at: int, size: int) -> bytes:
        self._file.seek(self._start + at)
        return self._file.read(size)


class Spill:
    """Where a merge's compressed runs wait: in memory up to ``HELD`` bytes, the rest in an unnamed file."""

    def __init__(self):
        self._left, self._file = HELD, None

    def keep(self, blob: bytes, start: int) -> _Held | _Filed:
        if len(blob) <= self._left:
            self._left -= len(blob)
            return _Held(blob, start)
        if self._file is None:
            self._file = tempfile.TemporaryFile()  # noqa: SIM115 - closed with the merge
        at = self._file.seek(0, os.SEEK_END)
        self._file.write(blob)
        return _Filed(self._file, at + start)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def merged(runs: list[Run]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, totals) in ascending order, from a heap of the runs' loaded ends; each run's own totals are added to it."""
    heap = [(int(r.keys[-1]), i) for i, r in enumerate(runs) if r.load()]
    heapq.heapify(heap)
    while heap:
        upto = np.uint64(heap[0][0])
        taken = [(r, *r.take(upto)) for r in runs if len(r.keys) and r.keys[0] <= upto]
        keys = np.concatenate([k for _, k, _ in taken])
        order = np.argsort(keys, kind="stable")
        starts = _grouped(keys[order])
        pairs = keys[order][starts]
        totals = np.add.reduceat(np.concatenate([c for _, _, c in taken])[order], starts)
        for run, own, _ in taken:
            run.totals.append(totals[np.searchsorted(pairs, own)])
        yield pairs, totals
        while heap and heap[0][0] <= int(upto):
            i = heapq.heappop(heap)[1]
            if runs[i].load():
                heapq.heappush(heap, (int(runs[i].keys[-1]), i))


RUNS = "chunk long, radix int, docs binary, pairs binary"


def write_runs(docs: DataFrame, make, radixes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, radix, docs, pairs): a chunk's documents (radix -1) and its runs.  ``make`` returns an ``Aligner`` in the task."""
    def flush(part: int, number: int, ids: list, done: list[Aligned]) -> pa.RecordBatch:
        chunk = (part << 32) | number
        base = np.cumsum([0] + [len(x.n_a) for x in done])
        key = np.concatenate([(x.b.astype(np.uint64) << np.uint64(A_BITS)) | x.a.astype(np.uint64) for x in done])
        doc = np.concatenate([x.doc + lo for x, lo in zip(done, base)]).astype(np.uint32)
        order = np.argsort(key, kind="stable")  # documents ascend already
        key, doc = key[order], doc[order]
        both = np.flatnonzero((key[1:] != key[:-1]) | (doc[1:] != doc[:-1])) + 1
        at = np.append(0, both) if len(key) else both
        times = np.diff(np.append(at, len(key))).astype(np.uint32)
        key, doc = key[at], doc[at]
        starts = _grouped(key)
        pairs, n_docs = key[starts], np.diff(np.append(starts, len(key))).astype(np.uint32)
        counts = np.add.reduceat(times.astype(np.uint64), starts) if len(starts) else np.zeros(0, np.uint64)
        radix = (mix64(pairs) % np.uint64(radixes)).astype(np.int64)
        own = np.argsort(radix, kind="stable")
        cuts = np.flatnonzero(np.diff(radix[own])) + 1
        entry_radix = np.repeat(radix, n_docs)
        entry_own = np.argsort(entry_radix, kind="stable")
        out = [(chunk, -1, _documents(ids, done), None)]
        at = 0
        for mine in np.split(own, cuts) if len(own) else []:
            n = int(n_docs[mine].sum())
            entries = entry_own[at:at + n]
            at += n
            out.append((chunk, int(radix[mine[0]]), _packed(n_docs[mine], doc[entries], times[entries]), _blocks(pairs[mine], counts[mine])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                                          names=["chunk", "radix", "docs", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, done, links = TaskContext.get().partitionId(), 0, [], [], 0
        with kept(("aligner", make.key), make) as aligner:
            for batch in batches:
                sizes = np.cumsum([len(t) if t else 0 for t in batch.column(1).to_pylist()])
                at = 0
                while at < len(batch):
                    end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
                    part_rows = batch.slice(at, end - at)
                    found = aligner.align(part_rows.column(1).to_pylist())
                    ids.append(part_rows.column(0))
                    done.append(found)
                    links += len(found.a)
                    at = end
                    if links >= LINKS:
                        yield flush(part, number, ids, done)
                        number, ids, done, links = number + 1, [], [], 0
            if ids:
                yield flush(part, number, ids, done)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RUNS)


def _documents(ids: list[pa.Array], done: list[Aligned]) -> bytes:
    """A chunk's documents as an Arrow stream: id, counts and digest."""
    columns = {"id": pa.concat_arrays(ids)}
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        columns[name] = pa.array(np.concatenate([getattr(x, name) for x in done]))
    columns["groups_sha256"] = pa.array(list(itertools.chain.from_iterable(x.groups_sha256 for x in done)), pa.string())
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def merge_runs(runs: DataFrame, radixes: int) -> DataFrame:
    """(chunk, radix, totals, b, best): each run's totals in its own order, and highest counts of B ids (chunk null)."""
    def finish(radix: int, own: list[Run], spill: Spill) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for pairs, totals in merged(own):
            b = (pairs >> np.uint64(A_BITS)).astype(np.int64)
            starts = _grouped(b)
            for i, top in zip(b[starts].tolist(), np.maximum.reduceat(totals, starts).tolist()):
                best[i] = max(best.get(i, 0), top)
        spill.close()
        yield _totals([(r.chunk, radix, _packed(np.concatenate(r.totals)), None, None) for r in own])
        yield _totals([(None, None, None, i, n) for i, n in best.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radix, own, spill = None, [], Spill()
        for batch in batches:
            for chunk, r, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if r != radix:
                    if own:
                        yield from finish(radix, own, spill)
                    radix, own, spill = r, [], Spill()
                own.append(Run(chunk, blob, spill))
        if own:
            yield from finish(radix, own, spill)

    dealt = runs.where("radix >= 0").select("chunk", "radix", "pairs").repartition(radixes, "radix").sortWithinPartitions("radix", "chunk")
    return dealt.mapInArrow(run, "chunk long, radix int, totals binary, b int, best long")


def _totals(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["chunk", "radix", "totals", "b", "best"])


def contributions(runs: DataFrame, totals: DataFrame, best: np.ndarray, id_type: str) -> DataFrame:
    """One row per document, from its chunk's runs and their totals; ``best`` is the highest count of each B id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n_best, count_sum, entry, chunk = None, None, None, None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*table.columns[:5], pa.array(n_best), pa.array(count_sum), table.column(5)],
                                              names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            for c, radix, kind, docs, pairs in zip(*(col.to_pylist() for col in batch.columns)):
                if radix < 0:
                    if table is not None:
                        yield result()
                    stream = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(docs))
                    table = stream.read_next_batch()
                    n_best, count_sum = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
                elif kind == 0:
                    entry = docs, pairs
                else:
                    _add(n_best, count_sum, *entry, docs, best)
        if table is not None:
            yield result()

    parts = runs.select("chunk", "radix", F.lit(0).alias("kind"), "docs", "pairs").unionByName(
        totals.where("chunk IS NOT NULL").select("chunk", "radix", F.lit(1).alias("kind"), F.col("totals").alias("docs"), F.lit(None).cast("binary").alias("pairs")))
    dealt = parts.repartition("chunk").sortWithinPartitions("chunk", "radix", "kind")
    return dealt.mapInArrow(run, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _add(n_best: np.ndarray, count_sum: np.ndarray, docs: bytes, pairs: bytes, totals: bytes, best: np.ndarray) -> None:
    """Adds one run's links to its documents' sums."""
    n_docs, doc, times = _unpacked(docs, "<u4", "<u4", "<u4")
    own, = _unpacked(totals, "<u8")
    run = Run(0, pairs, Spill())
    while run.load():
        pass
    highest = own.astype(np.int64) == best[(run.keys >> np.uint64(A_BITS)).astype(np.int64)]
    times = times.astype(np.int64)
    np.add.at(count_sum, doc, times * np.repeat(own.astype(np.int64), n_docs))
    np.add.at(n_best, doc, times * np.repeat(highest, n_docs))


class Pair:
    """Makes the aligner of two tokenizer files in a task."""

    def __init__(self, byte_path: str, piece_path: str):
        self.key = byte_path, piece_path

    def __call__(self) -> Aligner:
        return Aligner(byte_side(self.key[0]), piece_side(self.key[1]))


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    radixes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = stash(write_runs(docs, Pair(byte_path, piece_path), radixes, id_col, text_col), "alignment-runs")
    totals = stash(merge_runs(runs, radixes), "alignment-totals")
    tops = totals.where("b IS NOT NULL").groupBy("b").agg(F.max("best").alias("best")).collect()  # B's vocabulary at most
    best = np.zeros(1 + max((r.b for r in tops), default=0), np.int64)
    for r in tops:
        best[r.b] = r.best
    id_type = docs.schema[id_col].dataType.simpleString()
    return contributions(runs, totals, best, id_type).withColumnRenamed("id", id_col)
