"""Exact k-nearest-neighbour join (JN-7) and kNN classification (CLS-5, CLS-6).

Reference rows are parted by nearest centre and dealt into blocks (``metric``).  A query first visits
the blocks of its own part; its k-th distance there, or a distance within which the parts' sizes
promise k rows, bounds how far it must look, and it then visits only those parts that can hold anything
nearer.  A task keeps at most k rows a query over all its blocks, a window over these keeps the
global k.  Memory is bounded by a block and the queries held whatever the data size or key skew.  Where distances are too alike to
rule anything out, work is quadratic, as exact answers then require.

Rows whose vector is null, empty, of another length than the first reference's or not finite in every
component are neither queries nor references.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.operators.metric import BLOCK_ROWS, Block, Partition, Rows, as_vector, deal, fit, lowered, paired, summed, valid, visit, with_parts
from reviewlab.session import stash

__all__ = ["as_vector", "best_votes", "cluster_distance_sums", "knn_join", "knn_predict", "knn_vote_curve", "radius_join", "tuned_votes"]

#: Distances equal to this many digits are ties.
TIE_DIGITS = 9
#: So many rows of a block within the bound, for each of k, are looked at without ranking the block first.
FEW_HITS = 4
_FOUND = "qid long, rid long, dist double"


def _nearest(k: int, exclude_self: bool, apart: bool):
    """Kernel: the k nearest of a block for each visitor, no further than its bound."""
    def kernel(block: Block):
        ids, tags = block.rows.id, block.rows.tag

        def meet(q: Rows) -> pa.RecordBatch | None:
            near, error = block.rough(q.v)
            limit = q.bound * (1 + 1e-9) + 2 * 10.0 ** -TIE_DIGITS
            take = block.under(near, error, limit)
            if np.count_nonzero(take) > FEW_HITS * k * len(q):
                allowed = np.ones(near.shape, bool)
                if exclude_self:
                    allowed &= q.id[:, None] != ids[None, :]
                if apart:
                    allowed &= q.tag[:, None] != tags[None, :]
                near = np.where(allowed, near, np.inf)
                # the k-th screened value, and whatever may round to the same distance
                kth = np.partition(near, k - 1, axis=1)[:, k - 1] if k < near.shape[1] else np.full(len(q), np.inf)
                top = np.maximum(kth + error, 0)
                limit = np.minimum(limit, (np.sqrt(top) if block.metric == "euclidean" else top) + 2 * 10.0 ** -TIE_DIGITS)
                take = block.under(near, error, limit) & allowed
            i, j = np.nonzero(take)
            ok = np.ones(len(i), bool)
            if exclude_self:
                ok &= q.id[i] != ids[j]
            if apart:
                ok &= q.tag[i] != tags[j]
            i, j = i[ok], j[ok]
            d = paired(q.v[i], block.rows.v[j], block.metric)
            ok = d <= limit[i]
            i, j, d = i[ok], j[ok], d[ok]
            if not len(i):
                return None
            order = np.lexsort((ids[j], np.round(d, TIE_DIGITS), i))
            i, j, d = i[order], j[order], d[order]
            start = np.searchsorted(i, i)
            keep = np.arange(len(i)) - start < k
            return pa.RecordBatch.from_arrays([pa.array(q.id[i[keep]]), pa.array(ids[j[keep]]), pa.array(d[keep])], names=["qid", "rid", "dist"])
        return meet
    return kernel


def _closest(k: int):
    """Merge: the k nearest of each query among those found so far."""
    def merge(table: pa.Table) -> pa.Table:
        qid, rid, dist = (table.column(c).to_numpy() for c in ("qid", "rid", "dist"))
        order = np.lexsort((rid, np.round(dist, TIE_DIGITS), qid))
        own = qid[order]
        return table.take(pa.array(order[np.arange(len(own)) - np.searchsorted(own, own) < k]))
    return merge


def _kth(k: int):
    """Bounds of queries for which k rows are found already: the furthest of these."""
    def tighten(rows: Rows, found: pa.Table) -> None:
        qid, dist = (found.column(c).to_numpy() for c in ("qid", "dist"))
        order = np.lexsort((dist, qid))
        qid, dist = qid[order], dist[order]
        last = np.append(qid[1:] != qid[:-1], True)[:len(qid)]
        ends = np.flatnonzero(last)
        full = np.diff(ends, prepend=-1) >= k
        lowered(rows, qid[ends[full]], dist[ends[full]])
    return tighten


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # distances equal to 1e-9 count as ties and go to the smaller ref id, so
    # float noise cannot reorder mathematically equal distances
    w = Window.partitionBy("qid").orderBy(F.round("dist", TIE_DIGITS), "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _side(rows: DataFrame, id_col: str, vec: str, apart: str | None, name: str) -> DataFrame:
    """Valid (id, tag, v) rows of a written table: a filter on vectors that are still expressions would compute them anew for each of its terms."""
    tag = F.col(apart).cast("bigint") if apart else F.lit(0).cast("bigint")
    return valid(stash(rows.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(tag, F.lit(-1).cast("bigint")).alias("tag"),
                                   F.col(vec).cast("array<double>").alias("v")), name))


def knn_join(queries: DataFrame, refs: DataFrame, k: int, q_id: str = "id", r_id: str = "id",
             q_vec: str = "v", r_vec: str = "v", metric: str = "euclidean", exclude_self: bool = False,
             block_rows: int = BLOCK_ROWS, apart: str | None = None) -> DataFrame:
    """(qid, rid, dist, rank) for the k nearest refs of every query row;
    ties in distance go to the smaller ref id.  ``apart`` names a column of few whole numbers (folds, say):
    a query's neighbours are then rows of other values (null counts as one value)."""
    r = _side(refs, r_id, r_vec, apart, "knn-refs")
    first = r.select("id", "v").orderBy("id").limit(1).collect()
    spark = queries.sparkSession
    if not first:
        return spark.createDataFrame([], f"{_FOUND}, rank int")
    size = len(first[0].v)
    r = r.where(F.size("v") == size)
    same = queries is refs and (q_id, q_vec) == (r_id, r_vec)
    q = r if same else _side(queries, q_id, q_vec, apart, "knn-queries").where(F.size("v") == size)
    parts = fit(r, metric, block_rows, "tag" if apart else None)
    placed = with_parts(r, parts, ("tag",))
    kernel = _nearest(k, exclude_self, apart is not None)
    q = q.withColumn("bound", F.lit(float("inf")))
    if len(parts.centres) == 1:
        return _ranked(visit(q, placed, parts, kernel, _FOUND, merge=_closest(k), tighten=_kth(k)), k)
    placed = deal(placed, parts)

    def own(rows: Rows, away: np.ndarray, home: np.ndarray) -> np.ndarray:
        return np.arange(away.shape[1])[None, :] == home[:, None]

    near = stash(_ranked(visit(q, placed, parts, kernel, _FOUND, own, _closest(k)), k), "knn-own")
    kth = near.where(F.col("rank") == k).select(F.col("qid").alias("id"), F.col("dist").alias("kth"))
    bounded = q.drop("bound").join(kth, "id", "left").withColumn("bound", F.coalesce("kth", F.lit(float("inf")))).drop("kth")
    other = visit(bounded, placed, parts, kernel, _FOUND, reachable(parts, k + int(exclude_self)), _closest(k), _kth(k))
    return _ranked(near.drop("rank").unionByName(other), k)


def reachable(parts: Partition, k: int):
    """Which parts other than its own a query must visit for its k nearest."""
    def wants(rows: Rows, away: np.ndarray, home: np.ndarray) -> np.ndarray:
        bound = np.minimum(rows.bound, parts.most(away, rows.tag, k)) + 2 * 10.0 ** -TIE_DIGITS
        return (parts.least(away, home) <= bound[:, None]) & (np.arange(away.shape[1])[None, :] != home[:, None])
    return wants


def radius_join(queries: DataFrame, refs: DataFrame, radius: float, q_id: str = "id", r_id: str = "id",
                q_vec: str = "v", r_vec: str = "v", metric: str = "euclidean",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(qid, rid, dist) for every pair within ``radius`` (self pairs included)."""
    r = _side(refs, r_id, r_vec, None, "radius-refs")
    first = r.select("id", "v").orderBy("id").limit(1).collect()
    if not first:
        return queries.sparkSession.createDataFrame([], _FOUND)
    size = len(first[0].v)
    r = r.where(F.size("v") == size)
    parts = fit(r, metric, block_rows)
    limit = float(radius)

    def kernel(block: Block):
        def meet(q: Rows) -> pa.RecordBatch:
            i, j, d = block.pairs(q.v, np.full(len(q), limit))
            return pa.RecordBatch.from_arrays([pa.array(q.id[i]), pa.array(block.rows.id[j]), pa.array(d)], names=["qid", "rid", "dist"])
        return meet

    q = _side(queries, q_id, q_vec, None, "radius-queries").where(F.size("v") == size).withColumn("bound", F.lit(limit))
    return visit(q, with_parts(r, parts, ("tag",)), parts, kernel, _FOUND)


def knn_vote_curve(neigh: DataFrame, qlabels: DataFrame, rlabels: DataFrame) -> DataFrame:
    """CLS-5: accuracy for every k = 1..K from one K-neighbour join.

    ``neigh`` = (qid, rid, rank); the majority label among the first k
    neighbours (ties -> smaller label) is a running maximum of
    (count of the label so far, -label) along the ranks.
    """
    nb = neigh.join(rlabels.select(F.col("id").alias("rid"), F.col("label").alias("nlabel")), "rid")
    c = F.count(F.lit(1)).over(Window.partitionBy("qid", "nlabel").orderBy("rank")
                               .rowsBetween(Window.unboundedPreceding, 0))
    nb = nb.withColumn("c", c)
    best = F.max(F.struct(F.col("c"), -F.col("nlabel"))).over(
        Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    pred = nb.select("qid", F.col("rank").alias("k"), (-best["col2"]).alias("pred"))
    j = pred.join(qlabels.select(F.col("id").alias("qid"), F.col("label").alias("truth")), "qid")
    return j.groupBy("k").agg(F.avg((F.col("pred") == F.col("truth")).cast("double")).alias("accuracy"))


def knn_predict(neigh: DataFrame, rlabels: DataFrame, weights: str = "uniform", positive: int = 1) -> DataFrame:
    """CLS-6: weighted vote for binary labels -> (qid, probability, prediction).

    ``distance`` weights are 1/d; when some neighbours are at distance 0 only
    they vote.  The prediction is the class with the larger weight (ties -> 0).
    """
    nb = neigh.join(rlabels.select(F.col("id").alias("rid"), F.col("label").alias("nlabel")), "rid")
    if weights == "distance":
        zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
        w = F.when(zero == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    nb = nb.withColumn("w", w)
    agg = nb.groupBy("qid").agg(F.sum(F.when(F.col("nlabel") == positive, F.col("w")).otherwise(0.0)).alias("w1"),
                                F.sum("w").alias("wt"))
    return agg.select("qid", (F.col("w1") / F.col("wt")).alias("probability"),
                      (F.col("w1") > F.col("wt") - F.col("w1")).cast("int").alias("prediction"))


#: The search's candidates, in its order.
TUNING = [(metric, weights) for metric in ("euclidean", "manhattan") for weights in ("uniform", "distance")]


def tuned_votes(train: DataFrame, k: int, vec: str = "v", fold: str = "fold", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """CLS-6: (metric, weights, fold, n, accuracy) of a vote of k rows outside each row's own fold.

    A row is tested by the models of the other folds only, so one neighbour pass a metric that skips rows of the
    query's own fold gives what every model of the search would answer; both weightings vote over
    the same neighbours.
    """
    rows = stash(train.select("id", vec, fold, "label"), "knn-train")
    labels = rows.select("id", "label")
    out = None
    for metric in ("euclidean", "manhattan"):
        near = stash(knn_join(rows, rows, k, q_vec=vec, r_vec=vec, metric=metric, block_rows=block_rows, apart=fold), "knn-folds")
        for weights in ("uniform", "distance"):
            votes = knn_predict(near, labels, weights).select(F.col("qid").alias("id"), "prediction")
            part = (rows.join(votes, "id").groupBy(F.col(fold).alias("fold"))
                    .agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
                    .select(F.lit(metric).alias("metric"), F.lit(weights).alias("weights"), "fold", "n", "accuracy"))
            out = part if out is None else out.unionByName(part)
    return out


def best_votes(table: DataFrame) -> tuple[str, str]:
    """The (metric, weights) of the highest mean accuracy over folds, the first of equals."""
    means = {(r.metric, r.weights): r.a for r in table.groupBy("metric", "weights").agg(F.avg("accuracy").alias("a")).collect()}
    return max(TUNING, key=lambda c: round(means.get(c, 0.0), 12))


def _label_sums(block: Block):
    """Kernel: each visitor's distances to a block's rows, summed by their tags."""
    names, of = np.unique(block.rows.tag, return_inverse=True)
    one = np.eye(len(names))[of]
    count = np.bincount(of, minlength=len(names))

    def meet(q: Rows) -> pa.RecordBatch:
        d = block.apart(q.v)
        d[q.id[:, None] == block.rows.id[None, :]] = 0
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(q.id, len(names))), pa.array(np.tile(names, len(q))), pa.array((d @ one).ravel()),
                                           pa.array(np.tile(count, len(q)))], names=["qid", "cluster", "dsum", "cnt"])
    return meet


def cluster_distance_sums(points: DataFrame, label: str = "cluster", id_col: str = "id", vec: str = "v",
                          block_rows: int = 1024) -> DataFrame:
    """(qid, cluster, dsum, cnt): sum of distances from each point to the points
    of each cluster (itself included, at distance 0).  A point meets all blocks in one task, which
    emits one row per (point, cluster), never the pairs."""
    none = F.lit(np.iinfo(np.int64).min)
    rows = stash(points.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(label).cast("bigint"), none).alias("tag"),
                               F.lit(float("inf")).alias("bound"), F.col(vec).cast("array<double>").alias("v")), "cluster-rows")
    parts = fit(rows.select("id", "v"), block_rows=block_rows)

    def every(rows: Rows, away: np.ndarray, home: np.ndarray) -> np.ndarray:
        return np.ones(away.shape, bool)

    sums = visit(rows, with_parts(rows, parts, ("tag",)), parts, _label_sums, "qid long, cluster long, dsum double, cnt long", every,
                 summed(["qid", "cluster"], ["dsum", "cnt"]))
    return sums.groupBy("qid", "cluster").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
