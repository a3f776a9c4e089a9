"""Near-duplicate vectors against all pairs."""

import math

import numpy as np

from reviewlab.llm import pivots

SCHEMA = "vec_id long, embedding array<double>, label int, cls string, body string"


def brute(vectors, cosine=0.95):
    """{row: (links, component)} by all pairs."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = unit @ unit.T >= cosine
    comp = np.arange(len(vectors))
    while True:
        new = np.array([comp[row].min() for row in linked])
        if (new == comp).all():
            return linked.sum(axis=1) - 1, comp
        comp = new


def clouds(rng, sizes, noise, d=24, scaled=True):
    out = []
    for size, s in zip(sizes, noise):
        centre = rng.normal(size=d)
        out.append(centre / np.linalg.norm(centre) + s * rng.normal(size=(size, d)) / math.sqrt(d))
    rows = np.concatenate(out)
    return rows * rng.uniform(0.1, 9, (len(rows), 1)) if scaled else rows


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", "y") for i, v in rows], SCHEMA)


def got_of(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_matches_all_pairs(spark):
    rng = np.random.default_rng(8)
    vectors = clouds(rng, [1] * 400 + [2] * 40 + [60, 150, 90], [0.0] * 400 + [0.12] * 40 + [0.05, 0.16, 0.21])
    vectors = np.concatenate([vectors, vectors[:30], vectors[-70:]])  # exact copies
    ids = rng.permutation(len(vectors))
    links, _ = brute(vectors)
    order = np.argsort(ids)
    _, comp = brute(vectors[order])
    got = got_of(pivots.near_vectors(frame(spark, list(zip(ids.tolist(), vectors)))))
    want = dict(zip(ids.tolist(), links.tolist()))
    assert all(got[i][0] <= n for i, n in want.items())  # nothing below the threshold
    recall = sum(g[0] for g in got.values()) / sum(want.values())
    assert recall >= 0.98, recall
    assert np.mean([got[i][1] == c for i, c in enumerate(comp.tolist())]) >= 0.98
    assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def test_small_blocks_tiles_and_joins_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = clouds(rng, [1] * 100 + [120, 80], [0.0] * 100 + [0.08, 0.17])
    rows = list(enumerate(vectors))
    whole = got_of(pivots.near_vectors(frame(spark, rows)))
    links, comp = brute(vectors)
    assert whole == {i: (int(n), int(c), i == c) for i, (n, c) in enumerate(zip(links, comp))}
    for name, value in (("LIST", 16), ("SMALL", 0)):
        monkeypatch.setattr(pivots, name, value)
    assert got_of(pivots.near_vectors(frame(spark, rows))) == whole


def test_recall_at_the_threshold():
    """Pairs of exactly 0.95, the hardest: families, which hold their members' lists too, only find more."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1)[:, None] * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * z / np.linalg.norm(z, axis=1)[:, None]
    index = pivots.Index(x[:2000], 50_000, 0.95)
    a, b = index.keys(index.order(x)), index.keys(index.order(y))
    met = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    gap = index.sketch(x).astype(int) - index.sketch(y)
    near = (gap**2).sum(axis=1) <= index.reach(np.zeros(len(x)))
    assert near.all() and met.mean() >= 0.9, met.mean()


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v), (3, [2.0, 4.0, 6.0]), (5, v), (9, None), (10, [0.0, 0.0, 0.0]), (11, [1.0, None, 2.0]), (12, [math.inf, 1.0, 1.0]),
            (13, [1.0, 2.0]), (14, []), (None, v), (20, [-1.0, -2.0, -3.0]), (21, [1e300, 2e300, 3e300]), (22, [1e-300, 2e-300, 3e-300]), (13, [math.nan] * 3)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(frame(spark, rows)).collect()), key=str)
    linked = [(5, 4, 3, False), (5, 4, 3, False), (3, 4, 3, True), (21, 4, 3, False), (22, 4, 3, False)]
    alone = [(i, 0, i, True) for i in (9, 10, 11, 12, 13, 13, 14, 20)] + [(None, 0, None, True)]
    assert got == sorted(linked + alone, key=str)
    assert pivots.near_vectors(frame(spark, [])).collect() == []
    assert got_of(pivots.near_vectors(frame(spark, [(1, None)]))) == {1: (0, 1, True)}


def test_an_id_with_two_vectors(spark):
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in pivots.near_vectors(frame(spark, [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1])])).collect())
    assert got in ([(1, 0, 1), (1, 1, 1), (2, 1, 1)], [(1, 0, 1), (1, 0, 1), (2, 0, 2)])


def test_no_row_a_pair(spark):
    """A group of near copies costs rows in proportion to its size."""
    rng = np.random.default_rng(3)
    vectors = clouds(rng, [2000], [0.08])
    classes = spark.createDataFrame([(i, 1, v.astype("<f8").tobytes()) for i, v in enumerate(vectors)], "cls long, n long, body binary")
    index = pivots.fit(classes, len(vectors), "<f8", 24, 0.95)
    families = pivots._families(pivots._described(classes, index, "<f8", 24), index, "<f8", 24).where("keys IS NOT NULL")
    assert families.count() < 20
    assert pivots._met(pivots._entries(families), index).count() < 200
