"""Product codes of integer vectors, with nearest entries found by slicing and intersecting bitmasks.

A component x becomes the integer floor(256 * x).  Vectors are cut into ``PARTS`` equal
consecutive parts, each with a codebook of at most 64 entries, so that a set of entries is one
unsigned 64-bit mask.  For each part and dimension the entries' coordinates are sorted, and prefix
masks say which entries lie before each place.  An initial radius comes from the entries that lie
next to the query in each dimension: the nearest entry can't be further than the best of those.
The entries within that radius in one dimension are a range of the sorted coordinates, whose mask
is the exclusive-or of two prefix masks; the masks of all dimensions are ANDed, and what is left
are candidates among which the nearest entry (ties: the lowest index) certainly is.  Candidates
are measured in exact integers.

A round is one pass over the vectors: tasks send sums and counts of 64 entries a part, so what
reaches the driver (and goes back to the tasks as codebooks) is bounded by 64 times the vector's
length, whatever the number of rows.

Defined results: rows whose vector is null or holds a null, NaN or infinite component are dropped.
The length that counts is that of the kept vector with the smallest id (ties: the vector that sorts
first); other rows of another length, and rows with an integer beyond ``LIMIT``, stay with null code
and error and take no part in the codebooks.  That length must be a positive multiple of ``PARTS``, else all rows have
null codes.  Fewer vectors than ``ENTRIES`` give as many entries.  Null ids sort first and are
ordinary rows; repeated rows count each; null labels are one label; extra columns aren't read; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import stash

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest absolute integer of a component: squared distances of 4,096 such components fit 64 bits.
LIMIT = 1 << 24
#: Vectors handled at once in a task.
SLICE = 2048
#: Rows of the label sums up to which they are broadcast; larger ones are joined by shuffle.
LABELS = 100_000


class Codebook:
    """The entries of one part, ready for slicing: sorted coordinates and prefix masks a dimension."""

    def __init__(self, entries: np.ndarray):
        """``entries``: (at most 64, width) integers."""
        self.entries = entries
        n, width = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, 0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        self.prefix = np.zeros((n + 1, width), np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bits, axis=0)

    def _squared(self, points: np.ndarray, index: np.ndarray) -> np.ndarray:
        gap = points - self.entries[index]
        return np.einsum("ij,ij->i", gap, gap)

    def radius(self, points: np.ndarray) -> np.ndarray:
        """Per point an upper bound of the distance to its nearest entry, as a whole number: the
        entries on both sides of the point in each dimension are measured."""
        n, width = self.entries.shape
        best = np.full(len(points), np.iinfo(np.int64).max)
        for d in range(width):
            at = np.searchsorted(self.sorted[:, d], points[:, d])
            for side in (np.maximum(at - 1, 0), np.minimum(at, n - 1)):
                best = np.minimum(best, self._squared(points, self.order[side, d]))
        root = np.sqrt(best.astype(np.float64)).astype(np.int64)
        # floating square roots can be off by one either way: the largest r with r * r <= best
        root -= root * root > best
        return root + ((root + 1) * (root + 1) <= best)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries within ``radius`` in every dimension."""
        masks = np.full(len(points), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, "right")
            masks &= self.prefix[high, d] ^ self.prefix[low, d]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each point; ties to the lower index."""
        masks = self.candidates(points, self.radius(points))
        index = np.zeros(len(points), np.int64)
        error = np.full(len(points), np.iinfo(np.int64).max)
        rows = np.arange(len(points))
        while len(rows):
            # the lowest candidate of each row that still has one: indexes ascend, so only a smaller distance wins
            low = masks & (~masks + np.uint64(1))
            entry = np.log2(low.astype(np.float64)).astype(np.int64)
            masks = masks ^ low
            distance = self._squared(points[rows], entry)
            better = distance < error[rows]
            index[rows[better]], error[rows[better]] = entry[better], distance[better]
            left = masks != 0
            rows, masks = rows[left], masks[left]
        return index, error


def _integers(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """(kept, integers) of an Arrow list column: None for dropped rows and for integers beyond ``LIMIT``."""
    column = column.cast(pa.list_(pa.float64()))
    kept, out = np.zeros(len(column), bool), []
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()
    values = column.values
    there = values.is_valid().to_numpy(zero_copy_only=False)
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    fine = np.isfinite(flat) & there
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat * SCALE)
    for i in range(len(column)):
        own = slice(starts[i], starts[i + 1])
        kept[i] = valid[i] and fine[own].all()
        codable = kept[i] and not (np.abs(scaled[own]) > LIMIT).any()
        out.append(scaled[own].astype("<i8") if codable else None)
    return kept, out


def _whole(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, size, body) of the rows that aren't dropped; body null beyond ``LIMIT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                kept, whole = _integers(part.column(2))
                body = pa.array([None if x is None else x.astype("<i4").tobytes() for x in whole], pa.binary())
                size = pa.array([None if x is None else len(x) for x in whole], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), size, body],
                                                 names=["id", "label", "size", "body"]).filter(pa.array(kept))

    own = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    kinds = {f.name: f.dataType.simpleString() for f in own.schema}
    return own.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, size int, body binary")


def _points(bodies: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(bodies.to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums) of each entry's vectors, in one pass; pre-aggregated in the task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        own = [Codebook(b) for b in books]
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                points = _points(batch.column(0).slice(at, SLICE), parts * width)
                for p in range(parts):
                    mine = points[:, p * width:(p + 1) * width]
                    index = own[p].nearest(mine)[0] + p * entries
                    np.add.at(sums, index, mine)
                    counts += np.bincount(index, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array((used // entries).astype(np.int32)), pa.array((used % entries).astype(np.int32)), pa.array(counts[used]),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    made = vectors.select("body").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]
    return made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)


def train(vectors: DataFrame, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """(part, entry, width) codebooks after ``rounds`` rounds over (id, size, body) rows."""
    first = vectors.orderBy("id", "body").limit(ENTRIES).select("body").collect()
    books = np.stack([np.frombuffer(r.body, "<i4").astype(np.int64) for r in first]).reshape(len(first), PARTS, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = _sums(vectors, books).collect()  # 64 rows a part at most
        for r in sums:
            # whole-number division rounds down, for negative sums too
            books[r.part, r.entry] = [r[f"s{d}"] // r.n for d in range(books.shape[2])]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place, as decimal numbers."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(rows: DataFrame, size: int, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): two hex digits a part; null where the row can't be coded."""
    width = books.shape[2]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    pairs = np.array([f"{i:02x}".encode() for i in range(ENTRIES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Codebook(b) for b in books]
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                can = np.array([s == size for s in part.column(2).to_pylist()])
                code, error = np.full(len(part), None, object), np.zeros(len(part), np.int64)
                where = np.flatnonzero(can)
                if len(where):
                    points = _points(part.column(3).take(pa.array(where)), size)
                    found = [own[p].nearest(points[:, p * width:(p + 1) * width]) for p in range(PARTS)]
                    text = np.stack([pairs[index] for index, _ in found], axis=1)
                    code[where] = [b"".join(r).decode() for r in text.tolist()]
                    error[where] = sum(e for _, e in found)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(code.tolist(), pa.string()),
                                                  pa.array(error, pa.int64(), mask=~can)], names=["id", "label", "code", "error"])

    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the sum of ``error`` over equal labels; a label may hold any share of the rows."""
    sums = stash(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed("label", "of")
    if sums.count() <= LABELS:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    # many labels: spread each over 16 keys, so that one large label isn't one task's
    salt: Column = F.pmod(F.xxhash64("id", "code", "error"), F.lit(16)).cast("int")
    spread = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    both = coded.withColumn("own", salt).join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("salt")), "left")
    return both.drop("of", "own", "salt")


def encode(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           rounds: int = ROUNDS) -> DataFrame:
    """(``id_col``, ``label_col``, code, error, label_error, codebooks_sha256) of every row that isn't dropped."""
    whole = stash(_whole(rows, id_col, vec_col, label_col), "codes-vectors")
    first = whole.where("body IS NOT NULL").orderBy("id", "body").select("size").limit(1).collect()
    size = first[0].size if first else 0
    if size and size % PARTS == 0:
        books = train(whole.where(F.col("size") == size), size, rounds)
        coded = stash(_coded(whole, size, books), "codes")
        made = digest(books)
    else:
        coded = whole.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        made = digest(np.zeros((PARTS, 0, 0), np.int64))
    return _with_label_error(coded).select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error",
                                           F.lit(made).alias("codebooks_sha256"))
