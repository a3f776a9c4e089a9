"""Near-duplicate documents by min-max hashing.

A document's shingle set is hashed under ``perms`` permutations, and of each
permutation both the smallest and the largest value are kept: two nearly
independent, unbiased samples for one evaluation.  ``rows`` values make a band;
documents that agree on a band are candidates, and every candidate link is
confirmed on the full sets.

Buckets are never expanded into all their pairs.  First every member of a bucket
is compared with the bucket's smallest member only, which settles large groups of
copies in linear work.  Buckets whose members are then still in more than one
component make families (documents connected through such buckets); a family's
members are cut into blocks of about ``BLOCK`` shingles, a task compares two blocks
on their full sets at once, and blocks of one and the same component don't meet.
So every link between members of a bucket is found, with bounded memory per task.

With J = 0.8 a pair misses all 44 bands of 6 values with probability 1.6e-6.

Defined results: words are split at ASCII white space and A-Z lower-cased; a
document of fewer words than a shingle has its whole sequence as its only
shingle; null, empty and blank texts have none and are linked with nothing; rows
are the nodes, so rows that repeat an id keep their own decision (equal texts
always share a component); a null id names a component only where no other id
is in it; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import few, in_batches, stash
from reviewlab.llm.textkernel import Words, mix64, shingles, slices
from reviewlab.llm.workercache import give_back, lean
from reviewlab.operators.graph import connected_components

PERMS, ROWS = 132, 6
#: Shingles in a block of a family, about; a component of that many is cut into blocks of its own.
BLOCK = 250_000


def sorted_sets(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes in ascending order, and their ``first`` offsets."""
    hashes = hashes.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[first[:-1][first[:-1] < len(hashes)]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[first]


def set_digest(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each row's set (rows without shingles: 0)."""
    n = np.diff(first)
    some = n > 0
    out = np.zeros(len(n), np.uint64)
    if some.any():
        out[some] = mix64(np.add.reduceat(mix64(sets), first[:-1][some]) + n[some].astype(np.uint64))
    return out


def min_max(sets: np.ndarray, first: np.ndarray, perms: int) -> np.ndarray:
    """(rows, 2 * perms): smallest and largest value of each set under each permutation."""
    odd = np.random.default_rng(7).integers(0, 1 << 63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    starts = first[:-1]
    out = np.empty((len(starts), 2 * perms), np.uint64)
    for j in range(perms):
        value = sets * odd[j]
        np.minimum.reduceat(value, starts, out=out[:, 2 * j])
        np.maximum.reduceat(value, starts, out=out[:, 2 * j + 1])
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values; the band's number is part of it."""
    n, width = signature.shape
    bands = signature[:, :width // rows * rows].reshape(n, -1, rows)
    key = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64) + np.uint64(1), bands.shape[:2]).copy()
    for j in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j])
    return key


def _sketcher(k: int, perms: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(1)):
                sets, first = sorted_sets(*shingles(Words(buf, offsets), k))
                n = np.diff(first)
                some = np.flatnonzero(n)
                keys = np.zeros((0, 2 * perms // rows), np.uint64)
                if len(some):
                    keys = band_keys(min_max(sets, np.append(first[some], len(sets)), perms), rows)
                size = np.zeros(b - a + 1, np.int32)
                size[1:][some] = keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n.astype(np.int64)),
                     pa.array(set_digest(sets, first).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)),
                                              pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["id", "fp", "n", "cls", "bands"])
    return run


def _verifier(k: int, percent: int):
    def sets_of(column):
        for a, b, buf, offsets in slices(column):
            sets, first = sorted_sets(*shingles(Words(buf, offsets), k))
            digests = set_digest(sets, first)
            for r in range(b - a):
                yield sets[first[r]:first[r + 1]], digests[r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.asarray(batch.column(j)).view(np.uint64) for j in (0, 1))
            good = np.zeros(len(a), bool)
            for r, ((x, dx), (y, dy)) in enumerate(zip(sets_of(batch.column(2)), sets_of(batch.column(3)))):
                if dx == a[r] and dy == b[r]:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[r] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def _compared(k: int, percent: int):
    """Links between different components within the tiles of one task's table."""
    def links(cls: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        n = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(flat), bool)
        comp = comp.copy()
        for i in range(len(cls)):
            own = flat[starts[i]:starts[i] + n[i]]
            # a tile of one block compares each pair once, a tile of two the first block with the second
            open_ = (comp != comp[i]) & ((side != side[i]) if side.any() else (np.arange(len(cls)) > i))
            if side[i] or not open_.any():
                continue
            mark[own] = True
            both = np.add.reduceat(mark[flat], starts, dtype=np.int64)
            mark[own] = False
            for j in np.flatnonzero(open_ & (100 * both >= percent * (n[i] + n - both))):
                if comp[j] != comp[i]:
                    yield int(cls[i]), int(cls[j])
                    comp[comp == comp[j]] = comp[i]

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets: list[np.ndarray] = []
        for _, _, buf, offsets in slices(table["body"]):
            flat, first = sorted_sets(*shingles(Words(buf, offsets), k))
            sets += np.split(flat, first[1:-1])
        tile, cls, comp, side = (table[c].to_numpy() for c in ("tile", "cls", "comp", "side"))
        found = []
        for t in np.unique(tile):
            at = np.flatnonzero(tile == t)
            found += links(cls[at], comp[at], side[at], [sets[i] for i in at])
        del sets
        give_back()
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})
    return run


def _star(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's members with its smallest one, sizes allowing."""
    lead = buckets.groupBy("key").agg(F.min(F.struct("cls", "n")).alias("lead"))
    near = F.lit(100) * F.least("n", F.col("lead.n")) >= F.lit(percent) * F.greatest("n", F.col("lead.n"))
    return (buckets.join(lead, "key").where((F.col("cls") != F.col("lead.cls")) & near)
            .select(F.col("lead.cls").alias("a"), F.col("cls").alias("b")).distinct())


def _components(links: DataFrame) -> DataFrame:
    """(cls, comp) of the classes that have links."""
    nodes = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    return connected_components(nodes, links, "id", "a", "b").select(F.col("id").alias("cls"), F.col("component").alias("comp"))


def _tiles(members: DataFrame) -> DataFrame:
    """Rows (fam, cls, n, comp) as (task, tile, side, cls, comp): which blocks meet where.

    Large components of a family have blocks of their own; the others share blocks.
    """
    whole = (members.groupBy("fam", "comp").agg(F.sum("n").alias("weight"))
             .withColumn("own", F.when(F.col("weight") >= BLOCK, F.col("comp"))))
    size = whole.groupBy("fam", "own").agg(F.ceil(F.sum("weight") / BLOCK).alias("parts"))
    rows = (members.join(whole.select("fam", "comp", "own"), ["fam", "comp"])
            .join(size.withColumnsRenamed({"fam": "f", "own": "o"}), (F.col("fam") == F.col("f")) & F.col("own").eqNullSafe(F.col("o")))
            .withColumn("block", F.xxhash64(F.coalesce(F.col("own").cast("string"), F.lit("")), F.pmod(F.xxhash64("cls"), "parts"))))
    blocks = rows.groupBy("fam", "block").agg(F.any_value("own").alias("own"))
    x, y = (blocks.select("fam", F.col("block").alias(f"{c}_block"), F.col("own").alias(f"{c}_own")) for c in "xy")
    meet = x.join(y, "fam").where("x_block <= y_block AND (x_own IS NULL OR y_own IS NULL OR x_own <> y_own)")
    meet = meet.withColumn("tile", F.xxhash64("fam", "x_block", "y_block"))
    sides = meet.select("fam", "tile", F.col("x_block").alias("block"), F.lit(0).alias("side")).unionByName(
        meet.where("x_block < y_block").select("fam", "tile", F.col("y_block").alias("block"), F.lit(1).alias("side")))
    return rows.select("fam", "block", "cls", "n", "comp").join(sides, ["fam", "block"]).select("tile", "side", "cls", "n", "comp")


def _family_links(buckets: DataFrame, label: DataFrame | None, bodies: DataFrame, k: int, percent: int) -> DataFrame | None:
    """The links that the star comparison can't have seen."""
    rows = buckets.withColumn("comp", F.col("cls")) if label is None else (
        buckets.join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
    split = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rows = stash(rows.join(split, "key", "left_semi"), "near-open")
    if rows.isEmpty():
        return None
    # families of components: what the star comparison has joined is one node here
    held = rows.select("key", "comp").distinct()
    lead = held.groupBy("key").agg(F.min("comp").alias("a"))
    family = _components(held.join(lead, "key").select("a", F.col("comp").alias("b")).distinct())
    family = family.select(F.col("cls").alias("comp"), F.col("comp").alias("fam"))
    members = stash(rows.select("cls", "n", "comp").distinct().join(family, "comp"), "near-members")
    tiles = stash(_tiles(members), "near-tiles")
    # small tiles share a task
    tasks = tiles.agg(F.ceil(F.sum("n") / BLOCK)).first()[0]
    weight = tiles.groupBy("tile").agg(F.sum("n").alias("w"))
    tiles = (tiles.join(weight, "tile")
             .withColumn("task", F.when(F.col("w") > BLOCK / 4, F.col("tile")).otherwise(F.pmod("tile", F.lit(tasks)))))
    return (tiles.join(bodies, "cls").select("task", "tile", "side", "cls", "comp", "body")
            .groupBy("task").applyInArrow(_compared(k, percent), "a long, b long"))


def _fingerprint(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _decisions(docs: DataFrame, id_col: str, text_col: str, shingle: int = 5, percent: int = 80,
               perms: int = PERMS, rows: int = ROWS) -> DataFrame:
    """(id, fp, n, component): every row's component, and a fingerprint of its text beside its id."""
    texts = in_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    id_type = texts.schema["id"].dataType.simpleString()
    sketch = stash(texts.withColumn("fp", _fingerprint(F.col("body")))
                   .mapInArrow(lean(_sketcher(shingle, perms, rows)),
                               f"id {id_type}, fp long, n long, cls long, bands array<long>"), "near-sketch")
    # documents with equal sets are one class from here on
    classes = (sketch.where("n > 0").groupBy("cls")
               .agg(F.min("id").alias("id"), F.min(F.struct("id", "fp")).alias("rep"),
                    F.any_value("n").alias("n"), F.any_value("bands").alias("bands")))
    classes = stash(classes, "near-classes")
    bucket = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = bucket.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("key")
    bucket = stash(bucket.join(shared, "key"), "near-buckets")
    # the texts of the classes that share a bucket with another, one row's for each class
    used = stash(bucket.select("cls").distinct().join(classes.select("cls", "rep"), "cls"), "near-used")
    bodies = texts.join(few(used), F.col("id").eqNullSafe(F.col("rep.id")) & (_fingerprint(F.col("body")) == F.col("rep.fp")))
    bodies = stash(bodies.select("cls", "body"), "near-texts")
    pairs = stash(_star(bucket, percent), "near-pairs")
    sides = pairs.join(bodies.select(F.col("cls").alias("a"), F.col("body").alias("body_a")), "a").join(
        bodies.select(F.col("cls").alias("b"), F.col("body").alias("body_b")), "b").select("a", "b", "body_a", "body_b")
    links = stash(sides.mapInArrow(lean(_verifier(shingle, percent)), "a long, b long"), "near-links")
    label = None if links.isEmpty() else _components(links)
    more = _family_links(bucket, label, bodies, shingle, percent)
    if more is not None:
        more = stash(more, "near-family-links")
        if not more.isEmpty():
            label = _components(links.unionByName(more))
    out = sketch.select("id", "fp", "n", "cls")
    if label is None:
        named = classes.select("cls", F.col("id").alias("component_id"))
    else:
        member = classes.select("cls", "id").join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        least = member.groupBy("comp").agg(F.min("id").alias("component_id"))
        named = member.join(least, "comp").select("cls", "component_id")
    named = named.withColumn("some", F.lit(True))
    own = out.join(named, "cls", "left")
    component = F.when((F.col("n") > 0) & F.col("some"), F.coalesce("component_id", "id")).otherwise(F.col("id"))
    return own.select("id", "fp", "n", component.alias("component"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, kept."""
    return _decisions(docs, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id."""
    lost = (_decisions(docs, id_col, text_col, **options).where(~F.col("id").eqNullSafe(F.col("component")))
            .select(F.col("id").alias("lost_id"), F.col("fp").alias("lost_fp")).distinct())
    lost = stash(lost, "near-lost")
    return docs.join(few(lost), docs[id_col].eqNullSafe(lost["lost_id"])
                     & (_fingerprint(docs[text_col]) == lost["lost_fp"]), "left_anti")
