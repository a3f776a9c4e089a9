"""Metric partitions: which blocks of rows a row must visit to meet everything within a distance.

A bounded sample gives centres; every row belongs to its nearest centre, and each part keeps
its radius and its number of rows.  A row x at distance d(x, c) of a part's centre can have nothing in that
part nearer than d(x, c) - radius (triangle inequality), nor, in Euclidean space, nearer than the
plane half way between x's own centre and c; parts beyond x's bound are never visited.  Parts are
dealt into blocks of bounded size, which are written once, a folder each.  Visitors are shuffled once, neighbours
together; a task holds a bounded number of them and reads one block after another that any of them must meet, so
memory is bounded by a block and the visitors held whatever the skew, and what leaves the task is what its kernel
returns, merged over all the blocks that a visitor met, never the pairs as such.

Where nothing can be ruled out (distances that are all alike, as in many dimensions) every row
meets every block: distances are then rows x rows, the cost of exact answers, and blocks are read
rows / ``HELD`` times; what is shuffled and written stays in proportion to the rows.

Squared distances are screened by a matrix product around the block's mean with a bound on its
rounding error; whatever lies within that error of a limit is computed again over plain differences, so
results are those of plain differences.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.session import file_system, scratch_dir

BLOCK_ROWS = 2048
#: Most centres of a partition; more rows than they can part are dealt into more blocks a part.
CENTRES = 4096
#: Visitors that meet a block of ``BLOCK_ROWS`` at once, and visitors that a task holds while blocks are read.
BATCH, HELD = 256, 4096
#: Rows found that a task holds before they are merged or sent on, and rows sent on at once.
FOUND, SENT = 1 << 18, 1 << 16
#: Slack of bounds that are compared with distances, as a share of what is compared.
SLACK = 1e-9


def as_vector(cols) -> Column:
    """Pack numeric columns into an array<double> column."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def valid(rows: DataFrame, vec: str = "v", size: int | None = None) -> DataFrame:
    """Rows whose vector isn't null, has ``size`` components (default: any) and only finite ones."""
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))
    return rows.where(ok if size is None else ok & (F.size(v) == size))


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """(len(a), len(b)) distances, summed over plain differences one dimension at a time."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d if metric == "euclidean" else np.abs(d)
    return np.sqrt(out) if metric == "euclidean" else out


def paired(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of rows at the same place, over plain differences in the order of ``distances``."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        out += d * d if metric == "euclidean" else np.abs(d)
    return np.sqrt(out) if metric == "euclidean" else out


@dataclass
class Rows:
    """Rows in a task: ids, vectors, a tag (group, component, fold), a distance that bounds them and a number of their own."""
    id: np.ndarray
    v: np.ndarray
    tag: np.ndarray
    bound: np.ndarray
    extra: np.ndarray

    def __len__(self) -> int:
        return len(self.id)

    def part(self, lo: int, hi: int) -> Rows:
        return Rows(*(x[lo:hi] for x in (self.id, self.v, self.tag, self.bound, self.extra)))

    def take(self, at: np.ndarray) -> Rows:
        return Rows(*(x[at] for x in (self.id, self.v, self.tag, self.bound, self.extra)))

    @staticmethod
    def joined(rows: list[Rows]) -> Rows:
        return Rows(*(np.concatenate([getattr(r, c) for r in rows]) for c in ("id", "v", "tag", "bound", "extra")))


class Block:
    """The rows of a block, ready to be met."""

    def __init__(self, rows: Rows, metric: str):
        self.rows, self.metric = rows, metric
        if metric == "euclidean" and len(rows):
            self.mean = rows.v.mean(axis=0)
            own = rows.v - self.mean
            self.norms = np.einsum("ij,ij->i", own, own)
            # (q, 1, |q|^2) times this is |q - row|^2
            self.half = None
            self.wide = np.ascontiguousarray(np.column_stack([-2 * own, self.norms, np.ones(len(own))]).T)

    def screened(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        """(values, error): values that grow with the distance (squares, in Euclidean space) and how far off they can be."""
        if self.metric != "euclidean":
            return distances(v, self.rows.v, self.metric), 0.0
        q = v - self.mean
        norms = np.einsum("ij,ij->i", q, q)
        near = np.column_stack([q, np.ones(len(q)), norms]) @ self.wide
        return near, 1e-15 * (8 + v.shape[1]) * float(norms.max(initial=0) + self.norms.max(initial=0))

    def apart(self, v: np.ndarray) -> np.ndarray:
        """Distances of rows to the block's; short ones, of which the screen loses digits, over plain differences."""
        near, error = self.screened(v)
        if self.metric != "euclidean":
            return near
        i, j = np.nonzero(near <= error * 1e8)
        plain = np.zeros(len(i))
        for c in range(v.shape[1] if len(i) else 0):
            d = v[i, c] - self.rows.v[j, c]
            plain += d * d
        near[i, j] = plain
        return np.sqrt(np.maximum(near, 0))

    def within(self, v: np.ndarray, limit: float | np.ndarray) -> np.ndarray:
        """Which pairs are no further apart than ``limit`` (one, or one a row of ``v``)."""
        limit = np.broadcast_to(np.asarray(limit, float), len(v))[:, None]
        near, error = self.screened(v)
        if error == 0:
            return near <= (limit * limit if self.metric == "euclidean" else limit)
        square = limit * limit
        out = near <= square - error
        i, j = np.nonzero(np.abs(near - square) <= error + SLACK * square)
        out[i, j] = paired(v[i], self.rows.v[j], self.metric) <= limit[i, 0]
        return out

    def rough(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        """``screened`` in single precision, with the larger error of that, where numbers aren't too large for it."""
        q = v - self.mean if self.metric == "euclidean" else v
        norms = np.einsum("ij,ij->i", q, q)
        most = float(norms.max(initial=0) + self.norms.max(initial=0)) if self.metric == "euclidean" else np.inf
        if not most < 1e30:
            return self.screened(v)
        if self.half is None:
            self.half = self.wide.astype(np.float32)
        near = np.column_stack([q, np.ones(len(q)), norms]).astype(np.float32) @ self.half
        return near, 2.0 ** -22 * (8 + v.shape[1]) * most + 1e-30

    def under(self, near: np.ndarray, error: float, limit: np.ndarray) -> np.ndarray:
        """Which pairs' screened values don't rule out that they lie within ``limit`` (one a row)."""
        top = (limit * limit if self.metric == "euclidean" else limit) * (1 + SLACK) + error
        if near.dtype == np.float32:
            with np.errstate(over="ignore"):
                top = np.nextafter(top.astype(np.float32), np.float32(np.inf))
        return near <= top[:, None]

    def pairs(self, v: np.ndarray, limit: np.ndarray):
        """(row, block row, distance) of the pairs within ``limit``."""
        i, j = np.nonzero(self.under(*self.screened(v), limit))
        d = paired(v[i], self.rows.v[j], self.metric)
        ok = d <= limit[i]
        return i[ok], j[ok], d[ok]


@dataclass
class Partition:
    """Centres, radii and sizes of the parts of some rows (id, v)."""
    metric: str
    centres: np.ndarray
    radius: np.ndarray
    counts: np.ndarray
    block_rows: int
    #: rows of each part by tag, where visits leave out rows of the visitor's own tag
    tag_counts: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.counts // self.block_rows))

    @property
    def first_block(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.blocks)])

    def to_centres(self, v: np.ndarray) -> np.ndarray:
        return distances(v, self.centres, self.metric) if len(self.centres) > 1 or self.metric != "euclidean" else paired(
            v, np.broadcast_to(self.centres[0], v.shape), self.metric)[:, None]

    def least(self, away: np.ndarray, home: np.ndarray) -> np.ndarray:
        """(row, part) lower bounds of a row's distance to anything in a part, from its distances to all centres."""
        bound = away - self.radius[None, :]
        if self.metric == "euclidean" and len(self.centres) > 1:
            # only from the centres that these rows belong to: all of them against all would cost centres x centres for each batch
            own_parts, of = np.unique(home, return_inverse=True)
            between = distances(self.centres[own_parts], self.centres, self.metric)[of]
            own = away[np.arange(len(away)), home][:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (away * away - own * own) / (2 * between)
            bound = np.maximum(bound, np.where(between > 0, plane, 0.0))
        bound -= SLACK * (1 + away)
        return np.maximum(bound, 0.0)

    def most(self, away: np.ndarray, tags: np.ndarray, k: int) -> np.ndarray:
        """Per row a distance within which at least ``k`` rows of other tags (any, without tag counts) surely lie."""
        far = away + self.radius[None, :]
        counts = np.broadcast_to(self.counts, far.shape)
        if self.tag_counts:
            names, of = np.unique(tags, return_inverse=True)
            none = np.zeros_like(self.counts)
            counts = np.stack([self.counts - self.tag_counts.get(int(t), none) for t in names])[of]
        out = np.full(len(far), np.inf)
        # the nearest parts mostly hold enough rows; the others are sorted only where they don't
        left, first = np.arange(len(far)), min(64, far.shape[1])
        while len(left):
            own, of_own = far[left], counts[left]
            order = np.argpartition(own, first - 1, axis=1)[:, :first] if first < far.shape[1] else np.broadcast_to(np.arange(first), own.shape)
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(own, order, 1), axis=1), 1)
            enough = np.cumsum(np.take_along_axis(of_own, order, 1), axis=1) >= k
            some = enough.any(axis=1)
            at = np.take_along_axis(order, enough.argmax(axis=1)[:, None], 1)
            out[left[some]] = np.take_along_axis(own, at, 1)[some, 0] * (1 + SLACK)
            left = left[~some] if first < far.shape[1] else left[:0]
            first = far.shape[1]
        return out


def fit(points: DataFrame, metric: str = "euclidean", block_rows: int = BLOCK_ROWS, tag: str | None = None) -> Partition:
    """The partition of (id, v) rows: centres from a bounded sample chosen by the id's hash, radii and sizes in one pass.

    ``tag`` names a column of few values whose rows are counted apart.
    """
    n = points.count()
    wanted = 1 if n <= block_rows else min(CENTRES, 4 * math.ceil(n / block_rows))
    share = min(1.0, (4 * wanted + 64) / max(1, n))
    mixed = F.xxhash64("id")
    some = points.where(F.pmod(mixed, F.lit(1 << 30)) < math.ceil(share * (1 << 30))) if share < 1 else points
    chosen = some.orderBy(mixed, "id").limit(wanted).select("v").collect() or points.limit(1).select("v").collect()
    centres = np.unique(np.array([list(r.v) for r in chosen], float), axis=0) if chosen else np.zeros((0, 1))
    rough = Partition(metric, centres, np.zeros(len(centres)), np.zeros(len(centres), np.int64), block_rows)
    keys = ["part", *([tag] if tag else [])]
    found = with_parts(points, rough, (*([tag] if tag else []),)).groupBy(*keys).agg(F.max("away").alias("r"), F.count("*").alias("n")).collect()
    tags: dict[int, np.ndarray] = {}
    for r in found:
        rough.radius[r.part] = max(rough.radius[r.part], r.r)
        rough.counts[r.part] += r.n
        if tag and r[tag] is not None:
            tags.setdefault(int(r[tag]), np.zeros(len(centres), np.int64))[r.part] += r.n
    rough.tag_counts = tags
    return rough


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long vectors as a matrix."""
    if column.null_count:
        raise ValueError("a row without a vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def with_parts(points: DataFrame, parts: Partition, keep: tuple[str, ...] = ()) -> DataFrame:
    """(part, away, block, id, *keep, v): each row's part, distance to its centre and block."""
    kinds = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, first = parts.blocks, parts.first_block
        for whole in batches:
            for at in range(0, len(whole), BATCH * 4):
                batch = whole.slice(at, BATCH * 4)
                away = parts.to_centres(matrix(batch.column("v")))
                part = away.argmin(axis=1)
                block = first[part] + batch.column("salt").to_numpy() % blocks[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array(away[np.arange(len(part)), part]), pa.array(block.astype(np.int32)),
                     batch.column("id"), *(batch.column(c) for c in keep), batch.column("v")], names=["part", "away", "block", "id", *keep, "v"])

    rows = points.select("id", *keep, "v", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(1 << 40)).alias("salt"))
    return rows.mapInArrow(run, f"part int, away double, block int, id long{', ' + kinds if kinds else ''}, v array<double>")


@dataclass
class Dealt:
    """Rows (block, id, tag, extra, v and others) written with a folder for each block."""
    path: str
    rows: DataFrame


def deal(placed: DataFrame, parts: Partition) -> Dealt:
    """``placed`` rows as a stored table of which tasks can read one block at a time."""
    spark = placed.sparkSession
    rows = placed if "extra" in placed.columns else placed.withColumn("extra", F.lit(0.0))
    path, blocks = scratch_dir(spark, "blocks"), int(parts.blocks.sum())
    writers = max(1, min(blocks, max(2 * spark.sparkContext.defaultParallelism, blocks // 64)))
    rows.repartition(writers, "block").sortWithinPartitions("block", "id").write.partitionBy("block").parquet(path)
    return Dealt(path, spark.read.schema(rows.schema).parquet(path))


#: Blocks that a worker has read of one table, as long as they are small together: its next task may need them again.
_read: dict[tuple[str, int], Rows | None] = {}
_READ_BYTES = 64 << 20


def _waiting(path: str, block: int) -> Rows | None:
    """The rows of one block; none where it is empty."""
    if (path, block) in _read:
        return _read[path, block]
    fs, folder = file_system(f"{path}/block={block}")
    parts = []
    for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).read(columns=["id", "tag", "extra", "v"], use_threads=False).to_batches():
                    parts.append(Rows(batch.column("id").to_numpy(), matrix(batch.column("v")), batch.column("tag").to_numpy(), np.zeros(len(batch)),
                                      batch.column("extra").to_numpy()))
    rows = Rows.joined(parts) if parts else None
    if any(p != path for p, _ in _read) or sum(r.v.nbytes for r in _read.values() if r) > _READ_BYTES:
        _read.clear()
    _read[path, block] = rows
    return rows


def _visits(visitors: DataFrame, parts: Partition, wants: Callable[[Rows, np.ndarray, np.ndarray], np.ndarray], tasks: int) -> DataFrame:
    """The visitors that must meet anything, with the parts that they must meet as bits (``want``); a part's side by side."""
    # a part of many rows is spread over several tasks
    spreads = np.maximum(-(-parts.counts // HELD), max(1, 2 * tasks // max(1, len(parts.counts))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), BATCH):
                batch = whole.slice(at, BATCH)
                rows = _rows(batch)
                away = parts.to_centres(rows.v)
                home = away.argmin(axis=1)
                want = wants(rows, away, home)
                some = np.flatnonzero(want.any(axis=1))
                if not len(some):
                    continue
                mixed = (rows.id[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                spread = mixed.astype(np.int64) % spreads[home[some]]
                bits = np.packbits(want[some], axis=1)
                own = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home[some].astype(np.int32)), pa.array(spread.astype(np.int32)), *(batch.column(c).take(own) for c in ("id", "tag", "bound", "extra", "v")),
                     pa.array([b.tobytes() for b in bits], pa.binary())], names=_SENT_NAMES)

    sent = visitors.select("id", "tag", "bound", _extra(visitors), "v").mapInArrow(run, _SENT)
    return sent.repartition(tasks, "home", "spread").sortWithinPartitions("home", "spread", "id")


_SENT = "home int, spread int, id long, tag long, bound double, extra double, v array<double>, want binary"
_SENT_NAMES = ["home", "spread", "id", "tag", "bound", "extra", "v", "want"]


def _extra(rows: DataFrame) -> Column:
    return F.col("extra") if "extra" in rows.columns else F.lit(0.0).alias("extra")


def _rows(batch: pa.RecordBatch) -> Rows:
    return Rows(batch.column("id").to_numpy(), matrix(batch.column("v")), *(batch.column(c).to_numpy() for c in ("tag", "bound", "extra")))


def _dealt(visitors: DataFrame, placed: DataFrame | Dealt, parts: Partition, kernel, wants, schema: str, met) -> DataFrame:
    """``met(rows, meetings)`` for the visitors that a task holds; ``meetings`` are (which of them, what the kernel returns), block by block."""
    path = (placed if isinstance(placed, Dealt) else deal(placed, parts)).path
    n, cores = int(parts.counts.sum()), visitors.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(2 * cores, -(-n // 64)), -(-n // HELD))
    blocks, first, how = parts.blocks.tolist(), parts.first_block.tolist(), parts.metric

    def meetings(rows: Rows, want: np.ndarray) -> Iterator[tuple]:
        for part in np.flatnonzero(want.any(axis=0)).tolist():
            own = np.flatnonzero(want[:, part])
            for block in range(first[part], first[part] + blocks[part]):
                waiting = _waiting(path, block)
                if waiting is None:
                    continue
                meet = kernel(Block(waiting, how))
                step = max(BATCH, BATCH * BLOCK_ROWS // len(waiting))  # small blocks meet more visitors at once
                for at in range(0, len(own), step):
                    yield own[at:at + step], meet(rows.take(own[at:at + step]))

    def together(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows.joined([_rows(batch) for batch in held])
        bits = np.frombuffer(b"".join(x for batch in held for x in batch.column("want").to_pylist()), np.uint8)
        want = np.unpackbits(bits.reshape(len(rows), -1), axis=1, count=len(blocks)).view(bool)
        yield from met(rows, meetings(rows, want))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for at in range(0, len(whole), HELD):
                held.append(whole.slice(at, HELD))
                size += len(held[-1])
                if size >= HELD:
                    yield from together(held)
                    held, size = [], 0
        if size:
            yield from together(held)

    return _visits(visitors, parts, wants, tasks).mapInArrow(run, schema)


def visit(visitors: DataFrame, placed: DataFrame | Dealt, parts: Partition, kernel: Callable[[Block], Callable[[Rows], pa.RecordBatch | None]],
          schema: str, wants: Callable[[Rows, np.ndarray, np.ndarray], np.ndarray] | None = None,
          merge: Callable[[pa.Table], pa.Table] | None = None, tighten: Callable[[Rows, pa.Table], None] | None = None) -> DataFrame:
    """What ``kernel(block)`` returns for the batches of visitors that must meet the block.

    ``visitors`` has (id, tag, bound, v), ``placed`` (block, id, tag, v) from ``with_parts``, dealt already where several visits
    meet it; either may have ``extra``.  ``wants(rows, away, home)`` says which (visitor, part) pairs meet; by default those whose
    lower bound is within the visitor's bound.  A visitor meets all its blocks in one task, where ``merge`` folds
    the rows found so far into fewer, and ``tighten`` may lower the visitors' bounds by them.
    """
    if wants is None:
        def wants(rows: Rows, away: np.ndarray, home: np.ndarray) -> np.ndarray:
            return parts.least(away, home) <= rows.bound[:, None]

    def met(rows: Rows, meetings: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        few = FOUND if tighten is None else 4 * len(rows)
        found, size, limit = [], 0, few
        for _, out in meetings:
            if out is None or not len(out):
                continue
            found.append(out)
            size += len(out)
            if size < limit:
                continue
            if merge is None:
                yield from pa.Table.from_batches(found).combine_chunks().to_batches(SENT)
                found, size = [], 0
            else:
                table = merge(pa.Table.from_batches(found)).combine_chunks()
                if tighten is not None:
                    tighten(rows, table)
                found, size = table.to_batches(), len(table)
                limit = max(few, 2 * size)
        if found:
            table = pa.Table.from_batches(found)
            yield from (table if merge is None else merge(table)).combine_chunks().to_batches(SENT)

    return _dealt(visitors, placed, parts, kernel, wants, schema, met)


def visit_sums(visitors: DataFrame, placed: DataFrame | Dealt, parts: Partition, kernel: Callable[[Block], Callable[[Rows], np.ndarray]],
               width: int) -> DataFrame:
    """(id, tag, s): for each visitor the sum, over all blocks, of the ``width`` numbers that ``kernel(block)`` returns for it."""
    def every(rows: Rows, away: np.ndarray, home: np.ndarray) -> np.ndarray:
        return np.ones(away.shape, bool)

    def met(rows: Rows, meetings: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(rows), width))
        for at, out in meetings:
            total[at] += out
        for at in range(0, len(rows), BATCH):
            some = total[at:at + BATCH]
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * width), pa.array(some.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(rows.id[at:at + BATCH]), pa.array(rows.tag[at:at + BATCH]), sums], names=["id", "tag", "s"])

    return _dealt(visitors, placed, parts, kernel, every, "id long, tag long, s array<double>", met)


def lowered(rows: Rows, ids: np.ndarray, bounds: np.ndarray) -> None:
    """Bounds of visitors lowered to those given for distinct ids."""
    if not len(ids):
        return
    order = np.argsort(ids)
    ids, bounds = ids[order], bounds[order]
    at = np.minimum(np.searchsorted(ids, rows.id), len(ids) - 1)
    rows.bound = np.where(ids[at] == rows.id, np.minimum(rows.bound, bounds[at]), rows.bound)


def summed(keys: list[str], values: list[str]) -> Callable[[pa.Table], pa.Table]:
    """Merge: the sums of ``values`` for each of ``keys``."""
    def merge(table: pa.Table) -> pa.Table:
        out = table.group_by(keys, use_threads=False).aggregate([(v, "sum") for v in values])
        return pa.table([out.column(c) for c in keys] + [out.column(f"{v}_sum") for v in values], names=[*keys, *values])
    return merge


def per_block(placed: DataFrame, metric: str, work: Callable[[Block], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on each whole block of (block, id, tag, v) rows, in one task a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            return work(Block(Rows.joined(held), metric))

        for whole in batches:
            block = whole.column("block").to_numpy()
            cuts = (np.flatnonzero(block[1:] != block[:-1]) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(block)]):
                if hi == lo:
                    continue
                if block[lo] != now and held:
                    yield done()
                    held = []
                now = block[lo]
                held.append(_rows(whole.slice(lo, hi - lo)))
        if held:
            yield done()

    rows = placed.select("block", "id", "tag", F.lit(0.0).alias("bound"), _extra(placed), "v").repartition("block").sortWithinPartitions("block", "id")
    return rows.mapInArrow(run, schema)
