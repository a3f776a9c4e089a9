"""Vector codes against a plain version over all entries."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlab.llm import vectorcodes
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, id string, body string"


def brute(rows, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 16
    books = [[r[1][p * w:(p + 1) * w] for r in kept[:64]] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(16):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(p, v[p * w:(p + 1) * w])[1], []).append(v[p * w:(p + 1) * w])
            for j, xs in own.items():
                books[p][j] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], {}
    for i, v, lab in kept:
        found = [nearest(p, v[p * w:(p + 1) * w]) for p in range(16)]
        error = sum(d for d, _ in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append([i, "".join(f"{j:02x}" for _, j in found), error, lab])
    made = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], made) for i, c, e, lab in out), key=str)


def rows_of(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_matches_brute_force_with_edges(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 7 else None) for i, v in zip(rng.permutation(300), np.round(rng.normal(size=(300, 32)), 2))]
    rows += [rows[0], (rows[1][0], rows[2][1], 5), (None, rows[3][1], None), (900, None, 1), (901, [None] * 32, 1), (902, [float("nan")] * 32, 1),
             (903, [math.inf] + [0.0] * 31, 1), (904, [0.0] * 32, 2), (905, [1e-9] * 32, 2), (906, [-1e-9] * 32, None)]
    df = spark.createDataFrame([r + ("x", "y") for r in rows], SCHEMA)
    assert rows_of(vectorcodes.encode(df)) == brute(rows)


def test_few_equal_and_odd_vectors(spark):
    rows = [(i, [0.5] * 16, None) for i in range(5)]
    assert rows_of(vectorcodes.encode(spark.createDataFrame([r + ("", "") for r in rows], SCHEMA))) == brute(rows)
    odd = spark.createDataFrame([(1, [0.5] * 16, 1, "", ""), (2, [0.5] * 17, 1, "", ""), (3, [1e9] * 16, 1, "", ""), (4, [], 1, "", "")], SCHEMA)
    got = {r.vec_id: (r.code, r.error) for r in vectorcodes.encode(odd).collect()}
    assert got == {1: ("00" * 16, 0), 2: (None, None), 3: (None, None), 4: (None, None)}
    none = vectorcodes.encode(spark.createDataFrame([(2, [0.5] * 17, 1, "", "")], SCHEMA)).collect()
    assert [(r.vec_id, r.code) for r in none] == [(2, None)]
    assert vectorcodes.encode(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    rows = [(i, [float(i % 9)] * 16, i % 4 if i % 5 else None) for i in range(80)]
    df = spark.createDataFrame([r + ("", "") for r in rows], SCHEMA)
    monkeypatch.setattr(vectorcodes, "LABELS", 2)
    assert rows_of(vectorcodes.encode(df)) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.integers(0, 40), st.integers(0, 10**6))
def test_candidates_hold_the_nearest(n, width, spread, seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (n, width))
    points = rng.integers(-2 * spread - 1, 2 * spread + 2, (50, width))
    book = vectorcodes.Codebook(entries)
    square = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    index, error = book.nearest(points)
    assert (index == square.argmin(axis=1)).all() and (error == square.min(axis=1)).all()
    masks = book.candidates(points, book.radius(points))
    assert all(m >> int(i) & 1 for m, i in zip(masks.tolist(), index))


def test_registered_query_matches_duckdb(spark):
    import duckdb

    from reviewlab.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = con.execute(ORACLE["op12_vector_codes"]).df().sort_values("vec_id").reset_index(drop=True)
    got = QUERIES["op12_vector_codes"](spark, SMALL).toPandas().sort_values("vec_id").reset_index(drop=True)
    assert sorted(got.columns) == sorted(want.columns)
    for c in want.columns:
        assert got[c].tolist() == want[c].tolist(), c


@pytest.mark.parametrize("value", [2**61 - 1, 2**62 - 5, 0, 1, 24, 25, 26])
def test_radius_of_large_distances_is_exact(value):
    book = vectorcodes.Codebook(np.zeros((1, 1), np.int64))
    book._squared = lambda points, index: np.full(len(points), value)
    assert book.radius(np.zeros((1, 1), np.int64)).tolist() == [math.isqrt(value)]
