"""Near-duplicate vectors (cosine of 0.95 or more) by a pivot-permutation index.

Pivots are vectors of a bounded sample of which no two would link.  A vector is described by its
``NEAREST`` pivots in order of nearness; near duplicates see almost the same order.  Inverted
lists are kept for every ``SHARED`` pivots together: two vectors that share s of their nearest
pivots meet in C(s, ``SHARED``) lists, so meeting at all means a shared-pivot count of ``SHARED``
or more, and lists stay short because the number of pivots follows the cube root of the
number of vectors.  What meets is verified with whole vectors, so no pair below the threshold is linked.

Large groups of near copies are kept small before the lists.  Equal vectors are one class.  Vectors
with the same nearest pivot are cut into blocks, and in a block a vector joins the first one within half the
link angle: two members of such a *family* can't be further apart than the whole angle, so they
are linked without being compared.  Lists hold families (under the keys of all members).  For a pair of families the
angle of their leaders and their radii say, by the triangle inequality, that all members
are linked, or none; only where they leave it open are the members compared, in one task's
matrix that returns a row a member, never a row a pair.

A list entry carries its leader's place on the sample's principal axes in 16 bytes; as distances
only shrink under projection, entries too far apart there are passed over without losing a link.

The fit reads at most ``SAMPLE`` vectors; every vector is described, listed and verified.  Work on one group of
near copies that fit into families grows with the square of (rows / ``BLOCK``), not of rows;
a group so loose that few rows fit into a family costs its pairs.

Defined results: vectors that are null, zero, hold a null or non-finite component, or have another length
than the first valid vector (by id) link with nothing, nor do rows without an id (component null, kept);
of rows with the same id and different vectors only those with the smallest hash are compared; equal rows
are linked with each other; extra columns aren't read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import stash
from reviewlab.operators.graph import connected_components

COSINE = 0.95
SAMPLE = 4096
#: Pivots for each cube root of the number of vectors.
DENSITY = 12
NEAREST, SHARED = 6, 3
AXES = 16
#: Rows of a block in which families are formed, and of a tile of a long list.
BLOCK, LIST = 2048, 1024
#: Rows up to which a table of ids or of long lists is broadcast (16 bytes a row).
SMALL = 500_000
#: Angles closer than this to a bound are compared exactly.
MARGIN = 1e-7


def unit(bodies: pa.Array | list[bytes], dtype: str, size: int) -> np.ndarray:
    """Rows of raw components as vectors of length 1 in double precision."""
    raw = bodies.to_pylist() if isinstance(bodies, pa.Array) else bodies
    rows = np.frombuffer(b"".join(raw), dtype).reshape(-1, size).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow of squares
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _valid(rows: DataFrame, id_col: str, vec_col: str, dtype: str) -> DataFrame:
    """(id, size, hash, body): hash and body null for vectors that link with nothing."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(1)
            flat = vec.values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(dtype)
            fine, some = np.isfinite(flat), flat != 0
            at, there = vec.offsets.to_numpy(), vec.is_valid().to_numpy(zero_copy_only=False)
            data = flat.tobytes()
            hashes, bodies = [], []
            for i, ok in enumerate(there.tolist()):
                a, b = at[i], at[i + 1]
                ok = ok and b > a and fine[a:b].all() and some[a:b].any()
                bodies.append(data[a * width:b * width] if ok else None)
                hashes.append(hashlib.blake2b(bodies[-1], digest_size=16).digest() if ok else None)
            size = pa.array([None if x is None else len(x) // width for x in bodies], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(hashes, pa.binary()), pa.array(bodies, pa.binary())],
                                             names=["id", "size", "hash", "body"])

    kind = "float" if dtype == "<f4" else "double"
    own = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("vec"))
    return own.mapInArrow(run, "id long, size int, hash binary, body binary")


class Index:
    """Pivots, principal axes and block counts of a bounded sample of vectors."""

    def __init__(self, sample: np.ndarray, n: int, cosine: float):
        wanted = max(NEAREST, math.ceil(DENSITY * n ** (1 / 3)))
        pivots = sample[:0]
        for v in sample:
            if len(pivots) == wanted:
                break
            if not len(pivots) or (pivots @ v).max() < cosine:
                pivots = np.vstack([pivots, v])
        self.pivots, self.cosine = pivots, cosine
        self.angle = math.acos(cosine)
        self.axes = np.linalg.svd(sample, full_matrices=False)[2][:AXES]
        self.nearest = min(NEAREST, len(pivots))
        self.shared = min(SHARED, len(pivots))
        self.subsets = np.array(list(itertools.combinations(range(self.nearest), self.shared)))
        share = np.bincount(self.order(sample)[:, 0], minlength=len(pivots)) / len(sample)
        #: blocks into which each pivot's vectors are dealt
        self.blocks = np.maximum(1, np.ceil(share * n / BLOCK)).astype(np.int64)

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """The numbers of each vector's nearest pivots, nearest first (ties: the lower number)."""
        near = vectors @ self.pivots.T
        return np.argsort(-near, axis=1, kind="stable")[:, :self.nearest] if len(self.pivots) <= 4 * self.nearest else _top(near, self.nearest)

    def keys(self, order: np.ndarray) -> np.ndarray:
        """The list keys of each row: every ``shared`` of its pivots, whatever their order."""
        chosen = np.sort(order, axis=1)[:, self.subsets]
        keys = np.zeros(chosen.shape[:2], np.int64)
        for j in range(self.shared):
            keys = (keys << 20) | chosen[:, :, j]
        return keys

    def sketch(self, vectors: np.ndarray) -> np.ndarray:
        """Places on the principal axes, as signed bytes (zeros where there are fewer axes)."""
        out = np.zeros((len(vectors), AXES), np.int8)
        out[:, :len(self.axes)] = np.rint(127 * np.clip(vectors @ self.axes.T, -1, 1))
        return out

    def reach(self, spread: np.ndarray) -> np.ndarray:
        """Largest squared distance of sketches of leaders whose families, of radii that sum to
        ``spread``, can hold a link: rounding moves a coordinate's difference by 1 at most."""
        chord = 2 * np.sin(np.minimum(self.angle + spread, math.pi) / 2)
        return (127 * chord + math.sqrt(AXES) + 1e-6) ** 2


def _top(near: np.ndarray, k: int) -> np.ndarray:
    part = np.argpartition(-near, k, axis=1)[:, :k]
    part.sort(axis=1)
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable"), 1)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Stretches of whole runs: rows sorted by the first ``keys`` columns, cut only where these change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        last = [batch.column(j)[len(batch) - 1] for j in range(keys)]
        same = np.ones(len(batch), bool)
        for j in range(keys):
            same &= batch.column(j).to_numpy(zero_copy_only=False) == last[j].as_py()
        cut = len(batch) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            head = held[0] if held else None
            if head is not None and any(head.column(j)[0] != last[j] for j in range(keys)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    """Where each run of a table starts, and its end."""
    change = np.zeros(len(table), bool)
    change[0] = True
    for j in range(keys):
        col = table.column(j).to_numpy()
        change[1:] |= col[1:] != col[:-1]
    return np.append(np.flatnonzero(change), len(table))


def families_of(vectors: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """(leader, angle to it) of each vector, in order: a vector that no earlier leader has within ``angle`` leads."""
    n = len(vectors)
    leader, away = np.arange(n), np.zeros(n)
    if n < 2:
        return leader, away
    near = vectors @ vectors.T
    close = near >= math.cos(angle - MARGIN)
    free = np.ones(n, bool)
    for i in np.flatnonzero(close.sum(axis=1) > 1):
        if free[i]:
            own = np.flatnonzero(close[i] & free)
            own = own[own >= i]
            leader[own], free[own] = i, False
            away[own] = np.arccos(np.clip(near[i, own], -1, 1))
            away[i] = 0
    return leader, away


def _described(classes: DataFrame, index: Index, dtype: str, size: int) -> DataFrame:
    """Classes with their nearest pivot and block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                first = index.order(unit(part.column(2), dtype, size))[:, 0]
                block = part.column(3).to_numpy() % index.blocks[first]
                yield pa.RecordBatch.from_arrays([pa.array(first.astype(np.int32)), pa.array(block.astype(np.int32)), *part.columns[:3]],
                                                 names=["first", "block", "cls", "n", "body"])

    salt = F.pmod(F.xxhash64("cls"), F.lit(1 << 40))
    return classes.select("cls", "n", "body", salt.alias("salt")).mapInArrow(run, "first int, block int, cls long, n long, body binary")


def _families(described: DataFrame, index: Index, dtype: str, size: int) -> DataFrame:
    """(fam, cls, n, weight, radius, s0, s1, keys): the last five on the leader's row only."""
    def block(table: pa.Table) -> pa.RecordBatch:
        cls, n = table.column("cls").to_numpy(), table.column("n").to_numpy()
        vectors = unit(table.column("body").combine_chunks(), dtype, size)
        leader, away = families_of(vectors, index.angle / 2)
        lead = np.flatnonzero(leader == np.arange(len(cls)))
        place = np.searchsorted(lead, leader)
        weight, radius = np.zeros(len(lead), np.int64), np.zeros(len(lead))
        np.add.at(weight, place, n)
        np.maximum.at(radius, place, away)
        keys = index.keys(index.order(vectors))
        pairs = np.unique(np.stack([np.repeat(place, keys.shape[1]), keys.ravel()], axis=1), axis=0)
        counts = np.bincount(pairs[:, 0], minlength=len(lead))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(pairs[:, 1]))
        sketch = index.sketch(vectors[lead]).view("<i8").reshape(-1, 2)
        leads = leader == np.arange(len(cls))
        at = pa.array(np.where(leads, place, 0), mask=~leads)
        return pa.RecordBatch.from_arrays(
            [pa.array(cls[leader]), pa.array(cls), pa.array(n), pa.array(weight).take(at), pa.array(radius).take(at),
             pa.array(sketch[:, 0].copy()).take(at), pa.array(sketch[:, 1].copy()).take(at), lists.take(at)],
            names=["fam", "cls", "n", "weight", "radius", "s0", "s1", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 2):
            starts = _starts(table, 2)
            for a, b in itertools.pairwise(starts.tolist()):
                for at in range(a, b, BLOCK):
                    yield block(table.slice(at, min(BLOCK, b - at)))

    dealt = described.repartition("first", "block").sortWithinPartitions("first", "block", "cls")
    return dealt.mapInArrow(run, "fam long, cls long, n long, weight long, radius double, s0 long, s1 long, keys array<long>")


def _met(entries: DataFrame, index: Index) -> DataFrame:
    """(a, b, lists) with a < b: families that meet in lists and whose sketches allow a link."""
    def close(fam, radius, sketch, i, j):
        gap = sketch[i].astype(np.int32) - sketch[j]
        ok = (np.einsum("ij,ij->i", gap, gap) <= index.reach(radius[i] + radius[j])) & (fam[i] != fam[j])
        i, j = i[ok], j[ok]
        return np.minimum(fam[i], fam[j]), np.maximum(fam[i], fam[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 3):
            starts = _starts(table, 3)
            fam, radius = table.column("fam").to_numpy(), table.column("radius").to_numpy()
            sketch = np.stack([table.column(c).to_numpy() for c in ("s0", "s1")], axis=1).view(np.int8)
            low, high, chunk = (table.column(c).to_numpy() for c in ("low", "high", "chunk"))
            ends = np.repeat(starts[1:], np.diff(starts))
            cross = low != high
            left = np.flatnonzero(np.arange(len(fam)) + 1 < ends)
            step = 1
            while len(left):
                # every entry with the one ``step`` places on in its list; in a tile of two chunks only across
                there = left + step
                take = ~cross[left] | (chunk[left] != chunk[there])
                a, b = close(fam, radius, sketch, left[take], there[take])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                step += 1
                left = left[left + step < ends[left]]

    tiles = entries.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return tiles.mapInArrow(run, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("lists"))


def _entries(leaders: DataFrame) -> DataFrame:
    """(key, low, high, chunk, fam, radius, s0, s1): list entries; long lists in tiles of two chunks."""
    posted = leaders.select("fam", "radius", "s0", "s1", F.explode("keys").alias("key"))
    # how long a list is decides only how it is tiled, so one family in 16 is counted
    some = posted.where(F.pmod(F.xxhash64("fam"), F.lit(16)) == 0).groupBy("key").agg((F.count("*") * 16).alias("entries"))
    hot = stash(some.where(F.col("entries") > LIST).select("key", F.ceil(F.col("entries") / LIST).cast("int").alias("chunks")), "pivot-lists")
    sized = posted.join(F.broadcast(hot) if hot.count() <= SMALL else hot, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = sized.withColumn("chunk", F.pmod(F.xxhash64("fam"), F.col("chunks")).cast("int"))
    tiles = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return tiles.select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "fam", "radius", "s0", "s1")


def _bodies(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(cls, body) of the classes in ``ids`` (id): filtered before they are shuffled where the ids are few."""
    ids = stash(ids.distinct(), "pivot-ids")
    few = F.broadcast(ids) if ids.count() <= SMALL else ids
    return classes.select("cls", "body").join(few, F.col("cls") == F.col("id"), "left_semi")


def _judged(pairs: DataFrame, leaders: DataFrame, classes: DataFrame, index: Index, dtype: str, size: int) -> DataFrame:
    """(a, b, weight_a, weight_b, linked) of pairs of families: true, or null where members must be compared; others go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (unit(batch.column(c), dtype, size) for c in ("body_a", "body_b"))
            cosine = np.einsum("ij,ij->i", x, y)
            away = np.arccos(np.clip(cosine, -1, 1))
            spread = batch.column("radius_a").to_numpy() + batch.column("radius_b").to_numpy()
            alone = spread == 0
            every = np.where(alone, cosine >= index.cosine, away + spread <= index.angle - MARGIN)
            none = np.where(alone, ~every, away - spread > index.angle + MARGIN)
            out = batch.select(["a", "b", "weight_a", "weight_b"])
            linked = pa.array(every, mask=~every)
            yield pa.RecordBatch.from_arrays([*out.columns, linked], names=["a", "b", "weight_a", "weight_b", "linked"]).filter(pa.array(~none))

    used = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    info = stash(leaders.select(F.col("fam").alias("cls"), "weight", "radius").join(_bodies(classes, used), "cls"), "pivot-leaders")
    for side in "ab":
        pairs = pairs.join(info.select(F.col("cls").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("weight", "radius", "body"))), side)
    return pairs.select("a", "b", "weight_a", "weight_b", "radius_a", "radius_b", "body_a", "body_b").mapInArrow(
        run, "a long, b long, weight_a long, weight_b long, linked boolean")


def _compared(open_pairs: DataFrame, families: DataFrame, classes: DataFrame, index: Index, dtype: str, size: int) -> DataFrame:
    """(a, b, cls, links): members' links across pairs of families; cls null says that the pair has a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 2):
            starts = _starts(table, 2)
            a, b, side = (table.column(c).to_numpy() for c in ("a", "b", "side"))
            cls, n = table.column("cls").to_numpy(), table.column("n").to_numpy()
            for lo, hi in itertools.pairwise(starts.tolist()):
                vectors = unit(table.column("body").slice(lo, hi - lo).combine_chunks(), dtype, size)
                left = side[lo:hi] == 0
                linked = vectors[left] @ vectors[~left].T >= index.cosine
                if not linked.any():
                    continue
                own, ids = n[lo:hi], cls[lo:hi]
                links = np.concatenate([linked @ own[~left], own[left] @ linked])
                who = np.concatenate([ids[left], ids[~left]])
                some = links > 0
                pair = [pa.array(np.full(some.sum() + 1, x)) for x in (a[lo], b[lo])]
                yield pa.RecordBatch.from_arrays([*pair, pa.array([*who[some].tolist(), None], pa.int64()), pa.array([*links[some].tolist(), 0], pa.int64())],
                                                 names=["a", "b", "cls", "links"])

    fams = stash(open_pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pivot-open")
    few = F.broadcast(fams) if fams.count() <= SMALL else fams
    members = stash(families.select("fam", "cls", "n").join(few, F.col("fam") == F.col("id"), "left_semi"), "pivot-members")
    whole = stash(members.join(_bodies(classes, members.select(F.col("cls").alias("id"))), "cls"), "pivot-bodies")
    sides = [open_pairs.select("a", "b", F.col(c).alias("fam"), F.lit(s).alias("side")) for s, c in enumerate("ab")]
    rows = sides[0].unionByName(sides[1]).join(whole, "fam").select("a", "b", "side", "cls", "n", "body")
    return rows.repartition("a", "b").sortWithinPartitions("a", "b", "side", "cls").mapInArrow(run, "a long, b long, cls long, links long")


def fit(classes: DataFrame, n: int, dtype: str, size: int, cosine: float) -> Index:
    """The index of at most ``SAMPLE`` vectors, chosen by the hash of their id."""
    share = min(1.0, 2 * SAMPLE / n)
    mixed = F.xxhash64("cls", "body")
    some = classes.where(F.pmod(mixed, F.lit(1 << 30)) < math.ceil(share * (1 << 30))).withColumn("mixed", mixed)
    sample = some.orderBy("mixed").limit(SAMPLE).select("body").collect()
    return Index(unit([r.body for r in sample], dtype, size), n, cosine)


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) of every row."""
    dtype = "<f4" if rows.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    valid = _valid(rows, id_col, vec_col, dtype)
    sized = valid.where("id IS NOT NULL AND hash IS NOT NULL")
    first = sized.select("id", "size").orderBy("id", "size").limit(1).collect()
    bare = valid.select("id", "hash", "size")
    if not first:
        return _result(bare, None, None, id_col, 0)
    size = first[0].size
    classes = stash(sized.where(F.col("size") == size).groupBy("hash").agg(F.min("id").alias("cls"), F.count("*").alias("n"), F.first("body").alias("body")),
                    "pivot-classes")
    n = classes.count()
    index = fit(classes, n, dtype, size, cosine)
    families = stash(_families(_described(classes, index, dtype, size), index, dtype, size), "pivot-families")
    leaders = families.where("keys IS NOT NULL")
    pairs = stash(_met(_entries(leaders), index), "pivot-pairs")
    judged = stash(_judged(pairs.select("a", "b"), leaders, classes, index, dtype, size), "pivot-judged")
    compared = stash(_compared(judged.where("linked IS NULL").select("a", "b"), families, classes, index, dtype, size), "pivot-compared")
    sure = judged.where("linked")
    edges = sure.select("a", "b").unionByName(compared.where("cls IS NULL").select("a", "b"))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id"))
    components = connected_components(nodes, edges, "id", "a", "b").withColumnRenamed("id", "fam")
    across = sure.select(F.explode(F.array(F.struct(F.col("a").alias("fam"), F.col("weight_b").alias("w")),
                                           F.struct(F.col("b").alias("fam"), F.col("weight_a").alias("w")))).alias("x"))
    across = across.select("x.*").groupBy("fam").agg(F.sum("w").alias("across"))
    between = compared.where("cls IS NOT NULL").groupBy("cls").agg(F.sum("links").alias("between"))
    per_family = (leaders.groupBy("fam").agg(F.sum("weight").alias("weight"))
                  .join(across, "fam", "left").join(components, "fam", "left")
                  .select("fam", (F.col("weight") - 1 + F.coalesce("across", F.lit(0))).alias("own"), F.coalesce("component", "fam").alias("component")))
    # a family is one block's at most, so no family is a hot key
    links = (families.select("fam", "cls").join(per_family, "fam").join(between, "cls", "left")
             .groupBy("cls").agg(F.sum(F.col("own") + F.coalesce("between", F.lit(0))).alias("n_links"), F.min("component").alias("component")))
    return _result(bare, classes.where("n > 1").select("hash", F.col("cls").alias("copy_of")), stash(links, "pivot-links"), id_col, size)


def _clashing(bare: DataFrame) -> DataFrame:
    """(id, only): ids that stand on different vectors, with the smallest hash."""
    own = bare.where("id IS NOT NULL AND hash IS NOT NULL").groupBy("id").agg(F.min("hash").alias("only"), F.max("hash").alias("other"))
    return stash(own.where("only <> other").select("id", "only"), "pivot-clashes")


def _nothing(rows: DataFrame, id_col: str) -> DataFrame:
    """Rows that link with nothing."""
    return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(``id_col``, n_links, component_id, kept) of every row."""
    dtype = "<f4" if rows.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    valid = _valid(rows, id_col, vec_col, dtype)
    clashes = _clashing(valid.select("id", "hash"))
    valid = valid.withColumn("linkable", F.col("id").isNotNull() & F.col("hash").isNotNull())
    n_clashes = clashes.count()
    if n_clashes:
        few = F.broadcast(clashes) if n_clashes <= SMALL else clashes
        valid = valid.join(few, "id", "left").withColumn("linkable", F.col("linkable") & (F.col("only").isNull() | (F.col("only") == F.col("hash")))).drop("only")
    first = valid.where("linkable").select("id", "size").orderBy("id", "size").limit(1).collect()
    if not first:
        return _nothing(valid, id_col)
    size = first[0].size
    valid = valid.withColumn("linkable", F.col("linkable") & (F.col("size") == size))
    classes = valid.where("linkable").groupBy("hash").agg(F.min("id").alias("cls"), F.count("*").alias("n"), F.first("body").alias("body"))
    classes = stash(classes, "pivot-classes")
    links = _links(classes, dtype, size, cosine)
    copies = classes.where("n > 1").select("hash", F.col("cls").alias("copy_of"))
    own = valid.where("linkable").select("id", "hash").join(copies, "hash", "left").select("id", F.coalesce("copy_of", "id").alias("cls"))
    found = own.join(links, "cls").select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                                          (F.col("id") == F.col("component")).alias("kept"))
    return found.unionByName(_nothing(valid.where(~F.col("linkable")), id_col))


def _links(classes: DataFrame, dtype: str, size: int, cosine: float) -> DataFrame:
    """(cls, n_links, component) of every class (hash, cls, n, body) of equal vectors."""
    n = classes.count()
    index = fit(classes, n, dtype, size, cosine)
    families = stash(_families(_described(classes, index, dtype, size), index, dtype, size), "pivot-families")
    leaders = families.where("keys IS NOT NULL")
    pairs = stash(_met(_entries(leaders), index), "pivot-pairs")
    judged = stash(_judged(pairs.select("a", "b"), leaders, classes, index, dtype, size), "pivot-judged")
    compared = stash(_compared(judged.where("linked IS NULL").select("a", "b"), families, classes, index, dtype, size), "pivot-compared")
    sure = judged.where("linked")
    edges = sure.select("a", "b").unionByName(compared.where("cls IS NULL").select("a", "b"))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id"))
    components = connected_components(nodes, edges, "id", "a", "b").withColumnRenamed("id", "fam")
    across = sure.select(F.explode(F.array(F.struct(F.col("a").alias("fam"), F.col("weight_b").alias("w")),
                                           F.struct(F.col("b").alias("fam"), F.col("weight_a").alias("w")))).alias("x"))
    across = across.select("x.*").groupBy("fam").agg(F.sum("w").alias("across"))
    between = compared.where("cls IS NOT NULL").groupBy("cls").agg(F.sum("links").alias("between"))
    own = (leaders.select("fam", "weight").join(across, "fam", "left").join(components, "fam", "left")
           .select("fam", (F.col("weight") - 1 + F.coalesce("across", F.lit(0))).alias("own"), F.coalesce("component", "fam").alias("component")))
    # a family is at most a block, so none is a hot key
    links = families.select("fam", "cls").join(own, "fam").join(between, "cls", "left")
    return stash(links.select("cls", (F.col("own") + F.coalesce("between", F.lit(0))).alias("n_links"), "component"), "pivot-links")
