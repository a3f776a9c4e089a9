"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

For every benchmark item of L words, windows of L words of every document are
compared with it, or the whole text if it is shorter.  A window's SimHash sums +-weight of its words per bit.  The
64 bits are cut into 8 blocks: two fingerprints within ``RADIUS`` = 15 bits have
a block within 1 bit, so items are filed under each of their blocks' 9 values
within 1 bit, windows look up their own 8, and no fingerprint within the radius
is missed.  Candidates are then compared exactly by weighted Jaccard similarity
of their 5-word shingles (weight: the bytes and number of its words).

Windows that can't pass that last test get no fingerprint: a shingle that no
item of this length has adds to the union only, so a window needs ``threshold``
of its own weight in shingles of items of its length.  The items' shingle hashes
are broadcast, ``BLOCK_SHINGLES`` at most (8 MB with their length masks); a larger
benchmark is taken in blocks of items, each over all documents.

Words are runs of letters and digits, lower-cased, so case, punctuation and line
breaks don't matter.  Defined results: an item of fewer than 5 words is one
shingle as a whole; items without words match nothing; null and empty texts
match nothing; items with equal ids keep their own matches; an empty table on
either side gives no match; documents with equal ids are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import in_batches, stash
from reviewlab.llm.textkernel import ALNUM, SortedHashes, Words, mix64, rolling, slices
from reviewlab.llm.workercache import lean

K = 5
RADIUS, BLOCKS = 15, 8
#: Items' shingles whose hashes are broadcast at once, 16 bytes each.
BLOCK_SHINGLES = 500_000
_ITEM = "item_row long, item_id {id}, size int, simhash long, shingles array<long>, weights array<int>"
_WINDOW = "doc struct<id:{id},fp:long>, first_word int, size int, simhash long, shingles array<long>, weights array<int>"


def _words(column: pa.Array):
    for a, b, buf, offsets in slices(pc.utf8_lower(column)):
        yield a, b, Words(buf, offsets, ALNUM, signs=False)


def _shingled(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word sequence's shingles and their weights; fewer than K words are one shingle."""
    k = min(K, len(hashes))
    total = np.concatenate([[0], np.cumsum(sizes)])
    return rolling(hashes, k) ^ np.uint64(k), (total[k:] - total[:-k]).astype(np.int32)


def _bits(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(words + 1, 64): running sums of +-weight per bit of each word's hash."""
    spread = mix64(hashes + np.uint64(0x5851F42D4C957F2D))
    ones = np.unpackbits(spread.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
    out = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum((2 * ones - 1) * weights[:, None], axis=0, out=out[1:])
    return out


def _simhash(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items (row, id, text) with their length, fingerprint and shingles."""
    for batch in batches:
        for a, b, words in _words(batch.column(2)):
            out = []
            for r in range(b - a):
                own = slice(words.first[r], words.first[r + 1])
                h, w = words.hash[own], (words.end - words.start)[own] + 1
                if len(h):
                    shingle, weight = _shingled(h, w)
                    out.append((a + r, len(h), int(_simhash(_bits(h, w)[-1:])[0]), shingle.view(np.int64), weight))
            if out:
                at = pa.array([x[0] for x in out])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array([x[1] for x in out], pa.int32()),
                     pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.list_(pa.int64())),
                     pa.array([x[4] for x in out], pa.list_(pa.int32()))],
                    names=["item_row", "item_id", "size", "simhash", "shingles", "weights"])


class Gate:
    """The shingles of a block of items, and for each the lengths of the items that have it (as bits, mod 64)."""

    def __init__(self, items: list):
        flat = np.concatenate([np.array(x.shingles, np.int64).view(np.uint64) for x in items])
        bit = np.repeat(np.array([1 << x.size % 64 for x in items], np.uint64), [len(x.shingles) for x in items])
        self.index = SortedHashes(flat)
        self.mask = np.zeros(len(self.index.keys), np.uint64)
        np.bitwise_or.at(self.mask, self.index.find(flat), bit)
        self.sizes = sorted({x.size for x in items})
        self.least: dict[int, int] = {}
        for x in items:
            self.least[x.size] = min(sum(x.weights), self.least.get(x.size, 1 << 62))


def _windows(shared, threshold: float):
    def of_row(gate: Gate, h: np.ndarray, w: np.ndarray, mask: np.ndarray):
        """Windows (first word, size, fingerprint, shingles, weights) of one document that may match."""
        bits, shingle, weight = None, *_shingled(h, w)
        for size in gate.sizes:
            if size > len(h):  # the whole text is the only window, filed under the item's length
                hit = (mask >> np.uint64(size % 64)) & np.uint64(1)
                own = int(weight.sum())
                if len(h) >= K and own >= threshold * gate.least[size] - 1e-9 and (weight * hit.astype(np.int64)).sum() >= threshold * own - 1e-9:
                    bits = _bits(h, w) if bits is None else bits
                    yield 0, size, int(_simhash(bits[-1:])[0]), shingle.view(np.int64), weight
                continue
            if size < K:  # such a window is one shingle
                s, wt = rolling(h, size) ^ np.uint64(size), np.convolve(w, np.ones(size, np.int64), "valid").astype(np.int32)
                at = gate.index.find(s)
                starts, span = np.flatnonzero((at >= 0) & (gate.mask[at] >> np.uint64(size) & np.uint64(1) == 1)), 1
            else:
                s, wt, span = shingle, weight, size - K + 1
                hit = (mask >> np.uint64(size % 64)) & np.uint64(1)
                if not hit.any():
                    continue
                own, of = np.concatenate([[0], np.cumsum(weight)]), np.concatenate([[0], np.cumsum(weight * hit.astype(np.int64))])
                starts = np.flatnonzero(of[span:] - of[:-span] >= threshold * (own[span:] - own[:-span]) - 1e-9)
            if len(starts):
                bits = _bits(h, w) if bits is None else bits
                prints = _simhash(bits[starts + size] - bits[starts])
                for i, p in zip(starts.tolist(), prints.tolist()):
                    yield i, size, p, s[i:i + span].view(np.int64), wt[i:i + span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate: Gate = shared.value
        short = any(size < K for size in gate.sizes)
        for batch in batches:
            for a, b, words in _words(batch.column(1)):
                sizes = words.end - words.start + 1
                all_shingles = rolling(words.hash, K) ^ np.uint64(K)
                at = gate.index.find(all_shingles)
                hits = np.flatnonzero(at >= 0)
                rows = np.arange(b - a) if short else np.unique(np.searchsorted(words.first, hits, "right") - 1)
                found = []
                for r in rows.tolist():
                    lo, hi = words.first[r], words.first[r + 1]
                    if lo == hi:
                        continue
                    inside = at[lo:max(lo, hi - K + 1)]
                    mask = np.where(inside >= 0, gate.mask[inside], np.uint64(0))
                    if hi - lo < K:
                        mask = np.zeros(1, np.uint64)
                    found += [(a + r, *x) for x in of_row(gate, words.hash[lo:hi], sizes[lo:hi], mask)]
                for i in range(0, len(found), 4096):
                    part = found[i:i + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([x[0] for x in part])),
                         *(pa.array([x[j] for x in part], t) for j, t in (
                             (1, pa.int32()), (2, pa.int32()), (3, pa.int64()), (4, pa.list_(pa.int64())), (5, pa.list_(pa.int32()))))],
                        names=["doc", "first_word", "size", "simhash", "shingles", "weights"])
    return run


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of the smaller weights over that of the larger, each shingle's weights summed first."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(at[:len(a)], wa, len(keys))
    y = np.bincount(at[len(a):], wb, len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, wa, b, wb = (batch.column(n) for n in ("shingles", "weights", "item_shingles", "item_weights"))
            value = np.array([weighted_jaccard(*(np.asarray(c[i].values) for c in (a, wa, b, wb))) for i in range(len(batch))])
            # a whole text that is shorter than the item has fewer shingles than the item's length says
            size, n = np.asarray(batch.column("size")), np.array([len(x) for x in a], np.int32)
            size = pa.array(np.where(size < K, size, n + K - 1).astype(np.int32))
            out = pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc", "item_row", "item_id", "first_word")), size, batch.column("hamming"),
                                              pa.array(value, pa.float64())],
                                             names=["doc", "item_row", "item_id", "first_word", "size", "hamming", "similarity"])
            yield out.filter(pa.array(value >= threshold - 1e-9))
    return run


def _block(c: str, j) -> str:
    return f"(shiftrightunsigned({c}, {8 * j}) & 255L)"


def _matches(docs: DataFrame, items: DataFrame, shared, threshold: float, doc_id: str, item_id: str) -> DataFrame:
    """All verified (document, item, window) rows of one block of items."""
    windows = docs.mapInArrow(lean(_windows(shared, threshold)), _WINDOW.format(id=doc_id))
    near = ["0", *(str(1 << j) for j in range(8))]
    keyed = items.select("*", F.explode(F.expr("sequence(0, 7)")).alias("block"))
    value = "shiftrightunsigned({}, block * 8) & 255L"
    keyed = keyed.select("item_row", "item_id", "size", F.col("simhash").alias("item_hash"), F.col("shingles").alias("item_shingles"),
                         F.col("weights").alias("item_weights"), "block",
                         F.explode(F.expr(f"transform(array({','.join(near)}), x -> ({value.format('simhash')}) ^ x)")).alias("value"))
    probe = windows.select("*", F.explode(F.expr("sequence(0, 7)")).alias("block")).withColumn("value", F.expr(value.format("simhash")))
    first = "CASE " + " ".join(f"WHEN bit_count({_block('simhash', j)} ^ {_block('item_hash', j)}) <= 1 THEN {j}" for j in range(8)) + " END"
    pairs = (probe.join(keyed, ["size", "block", "value"])
             .withColumn("hamming", F.expr("bit_count(simhash ^ item_hash)"))
             .where(f"hamming <= {RADIUS} AND block = {first}"))  # a pair that shares blocks counts at the first only
    pairs = pairs.select("doc", "item_row", "item_id", "first_word", "size", "hamming", "shingles", "weights", "item_shingles", "item_weights")
    return pairs.mapInArrow(lean(_verify(threshold)), f"doc struct<id:{doc_id},fp:long>, item_row long, item_id {item_id}, "
                                                "first_word int, size int, hamming int, similarity double")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", threshold: float = 0.8, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc, item_row, item_id, first_word, size, hamming, similarity): every window that matches an item."""
    spark = docs.sparkSession
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("fp"))
    rows = in_batches(docs).select(doc.alias("doc"), F.col(text_col).alias("text"))
    doc_id = docs.schema[id_col].dataType.simpleString()
    item_id = benchmark.schema[item_col].dataType.simpleString()
    items = stash(benchmark.select(F.monotonically_increasing_id().alias("item_row"), F.col(item_col).alias("item_id"),
                                   F.col(item_text_col).alias("text"))
                  .mapInArrow(lean(_describe), _ITEM.format(id=item_id)), "leak-items")
    # blocks of items by running size, so that one block's shingles stay under the bound
    total = items.agg(F.sum(F.size("shingles"))).first()[0] or 0
    n_blocks = -(-total // block_shingles)
    found = None
    for i in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_row"), F.lit(n_blocks)) == i) if n_blocks > 1 else items
        gate = part.select("size", "shingles", "weights").collect()
        if gate:
            one = _matches(rows, part, spark.sparkContext.broadcast(Gate(gate)), threshold, doc_id, item_id)
            found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], f"doc struct<id:{doc_id},fp:long>, item_row long, item_id {item_id}, first_word int, "
                                         "size int, hamming int, similarity double")
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **options) -> DataFrame:
    """The best window of each document and item that match: (doc_id, item_id, first_word, n_words, hamming, similarity)."""
    best = leaks(docs, benchmark, id_col, item_col=item_col, **options).groupBy("doc", "item_row").agg(
        F.max_by(F.struct("item_id", "first_word", "size", "hamming", "similarity"),
                 F.struct("similarity", -F.col("first_word"))).alias("best"))
    return best.select(F.col("doc.id").alias(id_col), F.col("best.item_id").alias(item_col), "best.first_word",
                       F.col("best.size").alias("n_words"), "best.hamming", "best.similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    hit = stash(leaks(docs, benchmark, id_col, text_col, **options)
                .select(F.col("doc.id").alias("lost_id"), F.col("doc.fp").alias("lost_fp")).distinct(), "leak-documents")
    return docs.join(hit, docs[id_col].eqNullSafe(hit["lost_id"])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == hit["lost_fp"]), "left_anti")
