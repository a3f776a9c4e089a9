"""Byte-level BPE: encoding by a queue of merge ranks, decoding by joining vocabulary strings.

The vocabulary and merges come from a tokenizer file whose path is a parameter.
A piece of text is a doubly linked list of symbols; a priority queue holds
(rank, place) of every neighbouring pair that can merge, lowest rank first and
then leftmost.  Merging a pair rewrites the left symbol, unlinks the right one and
queues the two new pairs; entries whose pair has changed meanwhile are stale and
skipped.

Pieces repeat, so a worker keeps what it has encoded while a stage runs: ``PIECES`` of
either kind at most, of which the half met longest ago goes first.  A space after a non-space always starts a new
piece, so what stands between spaces is looked up as a whole first.

Defined results: null and empty texts have no ids; special tokens' strings in a
text are those tokens; very long runs without a space take O(n log n); other
columns aren't read; repeated rows each have a row; empty tables give empty tables.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import in_batches
from reviewlab.llm.workercache import kept

PIECES = 400_000
#: Fixed value: how byte-level BPE cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself if it
    is visible in Latin-1, else the next free letter from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Known(dict):
    """Ids by piece: those met since the dictionary was last half full, and in ``older`` those before them."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def keep(self, key: str, make: Callable[[], bytes]) -> bytes:
        """The ids of a key that isn't among the newer ones."""
        ids = self.older.get(key)
        if ids is None:
            ids = make()
        if len(key) <= 64:
            if len(self) >= PIECES // 2:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


class Bpe:
    """Vocabulary, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for word, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word, i in self.special.items():
            self.bytes_of[i] = word.encode()
        self.byte_ids = [0] * 256
        for c, b in letters.items():
            self.byte_ids[b] = vocab[c]
        #: by left id: right id -> rank; and the id that each rank's merge makes
        self.ranks: list[dict[int, int]] = [{} for _ in self.bytes_of]
        self.merged: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left]].setdefault(vocab[right], rank)
            self.merged.append(vocab[left + right])
        self._pieces = regex.compile(PATTERN)
        self._apart = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._space_run = re.compile(r"\s ")
        #: ids of pieces that start with a space, by what follows it, and of the other pieces
        self._words, self._others = Known(), Known()

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        if n == 1:
            return ids
        ranks, merged = self.ranks, self.merged
        # queue entries are rank * 2**shift + place, which compare faster than pairs
        shift = n.bit_length()
        low = (1 << shift) - 1
        queue = []
        for i in range(n - 1):
            rank = ranks[ids[i]].get(ids[i + 1])
            if rank is not None:
                queue.append(rank << shift | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        before, after = list(range(-1, n)), list(range(1, n + 1))
        ids.append(-1)  # the end: no id pairs with it
        while queue:
            entry = pop(queue)
            i = entry & low
            left = ids[i]
            if left < 0:
                continue  # stale: merged into its left neighbour
            j = after[i]
            rank = entry >> shift
            if ranks[left].get(ids[j]) != rank:
                continue  # stale: one of the two has changed
            left = ids[i] = merged[rank]
            ids[j] = -1
            k = after[i] = after[j]
            before[k] = i
            rank = ranks[left].get(ids[k])
            if rank is not None:
                push(queue, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = ranks[ids[h]].get(left)
                if rank is not None:
                    push(queue, rank << shift | h)
        return [i for i in ids if i >= 0]

    def _ids(self, piece: str) -> bytes:
        return np.array(self.merge(piece.encode()), "<u4").tobytes()

    def _pieces_of(self, text: str) -> bytes:
        out = []
        for piece in self._pieces.findall(text):
            if piece[0] == " " and len(piece) > 1:
                ids = self._words.get(piece[1:])
                out.append(self._word(piece[1:], piece) if ids is None else ids)
            else:
                ids = self._others.get(piece)
                out.append(self._others.keep(piece, lambda: self._ids(piece)) if ids is None else ids)
        return b"".join(out)

    def _word(self, word: str, piece: str) -> bytes:
        return self._words.keep(word, lambda: self._ids(piece))

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a space and what stands before the next one."""
        if len(chunk) > 1 and chunk[-1] in ".,;:!?" and chunk[-2].isalpha():
            # after a letter such a sign is a piece of its own
            stem = chunk[:-1]
            ids = self._words.get(stem)
            return (self._chunk(stem) if ids is None else ids) + self._pieces_of(chunk[-1])
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk, " " + chunk)
        pieces = self._pieces.findall(" " + chunk)
        if len(pieces) == 1 and chunk:
            return self._word(chunk, pieces[0])
        return self._pieces_of(" " + chunk)

    def _plain(self, text: str) -> bytes:
        if self._space_run.search(text):
            # a space run belongs to pieces that a cut at each space would break
            return self._pieces_of(text)
        head, *chunks = text.split(" ")
        get, found = self._words.get, [self._pieces_of(head)]
        for chunk in chunks:
            ids = get(chunk)
            found.append(self._chunk(chunk) if ids is None else ids)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self._apart is None or not any(word in text for word in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self._apart.finditer(text):
            out += [self._plain(text[at:m.start()]), np.array([self.special[m.group()]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that aren't UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids): each text's ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept(("bpe", path), lambda: Bpe(path)) as bpe:
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    ids = pa.array([bpe.encode(t) if t else b"" for t in part.column(1).to_pylist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["id", "ids"])

    rows = in_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, ids, decoded): the texts of ``ids_col``, null where it is null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept(("bpe", path), lambda: Bpe(path)) as bpe:
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    text = pa.array([None if x is None else bpe.decode(x) for x in part.column(1).to_pylist()], pa.string())
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], names=["id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, decoded string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids, decoded): ``encode`` and ``decode`` of each text by one worker a task, which holds one vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept(("bpe", path), lambda: Bpe(path)) as bpe:
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    ids = [bpe.encode(t) if t else b"" for t in part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
                                                     names=["id", "ids", "decoded"])

    rows = in_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens and the SHA-256 of its ids and of the text decoded from them."""
    return round_trip(docs, path, id_col, text_col).select(
        F.col(id_col), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
