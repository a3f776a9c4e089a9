"""Metric partitions: exact neighbours with fewer visits, whatever the blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.operators import knn, metric


def frame(spark, rows, schema="id long, v array<double>"):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v], *r) for i, v, *r in rows], schema)


def clusters(rng, n, d, k, spread=0.05):
    centres = rng.uniform(-5, 5, (k, d))
    return centres[rng.integers(0, k, n)] + spread * rng.normal(size=(n, d))


def brute(q, r, k, how, self_ids=False, tags=None):
    d = np.round(metric.distances(q, r, how), 9)
    if self_ids:
        np.fill_diagonal(d, np.inf)
    if tags is not None:
        d[tags[:, None] == tags[None, :]] = np.inf
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    return {(i, int(j)) for i, row in enumerate(order) for j in row if np.isfinite(d[i, j])}


@pytest.mark.parametrize("how", ["euclidean", "manhattan"])
@pytest.mark.parametrize("shape", ["clustered", "equal", "grid"])
def test_neighbours_are_exact_in_any_partition(spark, how, shape):
    rng = np.random.default_rng(3)
    pts = {"clustered": clusters(rng, 400, 3, 9), "uniform": rng.uniform(size=(400, 6)), "equal": np.ones((300, 2)),
           "grid": np.stack(np.meshgrid(np.arange(18.0), np.arange(18.0)), axis=-1).reshape(-1, 2)}[shape]
    rows = frame(spark, list(enumerate(pts)))
    got = {(r.qid, r.rid) for r in knn.knn_join(rows, rows, 4, metric=how, exclude_self=True, block_rows=25).collect()}
    assert got == brute(pts, pts, 4, how, self_ids=True)


def test_fewer_neighbours_than_asked_for(spark):
    pts = np.arange(5.0)[:, None]
    rows = frame(spark, list(enumerate(pts)))
    got = {(r.qid, r.rid) for r in knn.knn_join(rows, rows, 9, exclude_self=True, block_rows=2).collect()}
    assert got == {(i, j) for i in range(5) for j in range(5) if i != j}


def test_invalid_vectors_are_left_out(spark):
    rows = frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0]), (6, []), (7, [float("inf"), 0.0])])
    assert {(r.qid, r.rid) for r in knn.knn_join(rows, rows, 1, exclude_self=True).collect()} == {(1, 2), (2, 1)}
    assert knn.knn_join(rows.where("id = 3"), rows, 1).collect() == [] and knn.knn_join(rows, rows.where("id = 3"), 1).collect() == []


def test_clustered_rows_visit_few_blocks(spark):
    rng = np.random.default_rng(5)
    pts = clusters(rng, 3000, 4, 30)
    rows = frame(spark, list(enumerate(pts))).withColumn("tag", F.lit(0).cast("long")).withColumn("bound", F.lit(0.3))
    parts = metric.fit(rows, block_rows=100)
    blocks = int(parts.blocks.sum())
    wants = lambda r, away, home: parts.least(away, home) <= r.bound[:, None]
    visits = metric._visits(rows, parts, wants, 1).count()
    assert visits < 0.15 * 3000 * blocks, (visits, blocks)


def test_votes_outside_a_rows_own_fold(spark):
    rng = np.random.default_rng(6)
    pts = rng.normal(size=(240, 2))
    label = (pts[:, 0] + 0.4 * rng.normal(size=240) > 0).astype(int)
    fold = rng.integers(0, 5, 240)
    rows = frame(spark, [(i, p, int(y), int(f)) for i, (p, y, f) in enumerate(zip(pts, label, fold))], "id long, v array<double>, label int, fold int")
    got = {(r.metric, r.weights, r.fold): (r.n, round(r.accuracy, 9)) for r in knn.tuned_votes(rows, 7, block_rows=40).collect()}
    for how, weights in knn.TUNING:
        near = brute(pts, pts, 7, how, tags=fold)
        d = metric.distances(pts, pts, how)
        right = np.zeros(240, bool)
        for i in range(240):
            mine = [j for a, j in near if a == i]
            w = np.array([1.0 if weights == "uniform" else 1 / d[i, j] for j in mine])
            one = w[[label[j] == 1 for j in mine]].sum()
            right[i] = int(one > w.sum() - one) == label[i]
        for f in range(5):
            own = fold == f
            assert got[how, weights, f] == (own.sum(), round(right[own].mean(), 9))


def test_rows_are_sent_once_where_nothing_can_be_ruled_out(spark):
    rng = np.random.default_rng(9)
    rows = frame(spark, list(enumerate(rng.normal(size=(400, 24))))).withColumn("tag", F.lit(0).cast("long")).withColumn("bound", F.lit(float("inf")))
    parts = metric.fit(rows, block_rows=40)
    assert int(parts.blocks.sum()) > 5
    every = lambda r, away, home: np.ones(away.shape, bool)
    assert metric._visits(rows, parts, every, 1).count() == 400


def test_what_a_row_finds_is_merged_over_its_blocks(spark):
    rng = np.random.default_rng(10)
    pts = rng.normal(size=(300, 5))
    rows = frame(spark, list(enumerate(pts))).withColumn("tag", F.col("id") % 3).withColumn("bound", F.lit(float("inf")))
    parts = metric.fit(rows, block_rows=30)
    found = metric.visit(rows, metric.with_parts(rows, parts, ("tag",)), parts, knn._label_sums, "qid long, cluster long, dsum double, cnt long",
                         merge=metric.summed(["qid", "cluster"], ["dsum", "cnt"])).collect()
    assert len(found) == 300 * 3
    want = metric.distances(pts, pts, "euclidean")
    for r in found:
        own = np.arange(300) % 3 == r.cluster
        assert r.cnt == own.sum() and abs(r.dsum - want[r.qid, own].sum()) < 1e-9


def test_distances_of_copies_are_zero_far_from_the_mean():
    v = np.repeat(np.random.default_rng(11).normal(size=(4, 6)) * 1e4, 5, axis=0)
    got = metric.Block(metric.Rows(*(np.arange(20),), v, *(np.zeros(20) for _ in range(3))), "euclidean").apart(v)
    assert np.allclose(got, metric.distances(v, v, "euclidean"), atol=1e-7) and (got[0, :5] == 0).all()


def test_bounds_cost_rows_times_centres(monkeypatch):
    rng = np.random.default_rng(11)
    parts = metric.Partition("euclidean", rng.normal(size=(300, 3)), rng.uniform(0, 0.2, 300), rng.integers(0, 4, 300), 100)
    v = rng.normal(size=(9, 3))
    away = parts.to_centres(v)
    home, met = away.argmin(axis=1), []
    between = metric.distances(parts.centres, parts.centres, "euclidean")[home]
    plain = metric.distances
    monkeypatch.setattr(metric, "distances", lambda a, b, how: met.append(len(a) * len(b)) or plain(a, b, how))
    got = parts.least(away, home)
    assert sum(met) <= 9 * 300
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (away ** 2 - away[np.arange(9), home][:, None] ** 2) / (2 * between)
    want = np.maximum(away - parts.radius, np.where(between > 0, plane, 0.0)) - metric.SLACK * (1 + away)
    assert np.array_equal(got, np.maximum(want, 0.0))


@pytest.mark.parametrize("k", [1, 5, 200, 10_000])
@pytest.mark.parametrize("n", [3, 64, 300])
def test_distance_within_which_enough_rows_lie(n, k):
    rng = np.random.default_rng(n)
    parts = metric.Partition("manhattan", rng.normal(size=(n, 2)), rng.uniform(0, 0.2, n), rng.integers(0, 4, n), 100)
    parts.tag_counts = {1: np.minimum(parts.counts, 2), 2: parts.counts * (np.arange(n) % 2)}
    away, tags = parts.to_centres(rng.normal(size=(7, 2))), np.array([1, 2, 3, 1, 2, 1, 3])
    want = []
    for row, tag in zip(away + parts.radius, tags.tolist()):
        held = np.cumsum((parts.counts - parts.tag_counts.get(tag, 0))[np.argsort(row, kind="stable")])
        want.append(np.sort(row)[(held >= k).argmax()] * (1 + metric.SLACK) if held[-1] >= k else np.inf)
    assert np.array_equal(parts.most(away, tags, k), want)


def test_vectors_are_computed_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def seen(x):
        counted.add(1)
        return float(x)
    slow = F.udf(seen, "double")
    rows = spark.range(50).select("id", F.array(slow("id"), F.lit(0.0)).alias("v"))
    assert knn.knn_join(rows, rows, 1, exclude_self=True, block_rows=10).count() == 50
    assert counted.value == 50
