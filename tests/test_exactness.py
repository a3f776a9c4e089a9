"""Cases that the given tables don't hold: ties, large values, small classes, missing labels and words."""

import numpy as np
import pytest

from reviewlab.operators import cluster, regress
from reviewlab.operators.balance import balance, smote
from reviewlab.operators.knn import knn_join, radius_join


def _vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, v array<double>")


@pytest.mark.parametrize("block_rows", [64, 512, 5000])
def test_knn_ties_go_to_the_smaller_id_in_any_block_size(spark, block_rows):
    refs = _vectors(spark, [(i, (1.0, 0.0)) for i in range(1, 3001, 2)])
    got = knn_join(_vectors(spark, [(0, (0.0, 0.0))]), refs, 3, block_rows=block_rows).orderBy("rank").collect()
    assert [r["rid"] for r in got] == [1, 3, 5]


def test_knn_and_radius_keep_digits_of_large_values(spark):
    base = 1.7e9
    pts = _vectors(spark, [(i, (base + i,)) for i in range(100)])
    one = knn_join(_vectors(spark, [(50, (base + 50,))]), pts, 3, exclude_self=True, block_rows=16).orderBy("rank").collect()
    assert [r["rid"] for r in one] == [49, 51, 48]
    assert radius_join(pts, pts, 1.5, block_rows=16).count() == 298


@pytest.mark.parametrize("big,small", [(100, 60), (10, 10), (40, 2), (40, 3)])
def test_smote_makes_exactly_what_is_missing(spark, big, small):
    rows = [(i, float(i), float(i % 7), 0) for i in range(big)] + [(1000 + i, float(i), 1.0, 1) for i in range(small)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    assert smote(df, ["a", "b"]).count() == big - small
    assert {r["label"]: r["count"] for r in balance(df, ["a", "b"]).groupBy("label").count().collect()} == {0: big, 1: big}


def test_smote_of_a_single_row_is_an_error(spark):
    df = spark.createDataFrame([(i, float(i), int(i == 0)) for i in range(5)], "id long, a double, label int")
    with pytest.raises(ValueError):
        smote(df, ["a"])


def test_ols_on_large_uncentred_values(spark):
    n = 200
    df = spark.createDataFrame([(1e8 + i, float(i % 5), 3.0 + 2 * (1e8 + i) - (i % 5) + 0.01 * ((i * 7919) % 11 - 5)) for i in range(n)],
                               "x double, z double, y double")
    fit = regress.fit(df, ["x", "z"], "y")
    assert abs(fit.beta[1] - 2) < 1e-4 and abs(fit.beta[2] + 1) < 1e-2 and fit.r2 > 0.99999
    x = np.array([[1, r["x"] - 1e8, r["z"]] for r in df.collect()])
    y = np.array([r["y"] - 2e8 for r in df.collect()])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    resid = y - x @ beta
    assert abs(fit.ssr - resid @ resid) < 1e-3 * (resid @ resid) + 1e-6
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (resid @ resid) / (n - 3))
    assert np.allclose(fit.se[1:], se[1:], rtol=1e-3)
    inside = regress.mean_interval(df, fit).where("y BETWEEN mean_ci_lower - 1 AND mean_ci_upper + 1").count()
    assert inside == n


def test_ols_leaves_incomplete_rows_out_of_every_sum(spark):
    rows = [(float(i), float(i % 3), 2.0 * i + 1 - (i % 3)) for i in range(50)]
    more = [(None, 1.0, 500.0)] * 50 + [(1.0, None, 7.0), (2.0, 1.0, None), (float("nan"), 1.0, 3.0)]
    df = spark.createDataFrame(rows + more, "x double, z double, y double")
    got, want = regress.fit(df, ["x", "z"], "y"), regress.fit(df.limit(0).unionByName(spark.createDataFrame(rows, df.schema)), ["x", "z"], "y")
    assert got.n == 50 and got.dropped == 53 and want.dropped == 0
    assert np.allclose(got.beta, [1, 2, -1]) and np.allclose(got.beta, want.beta) and got.r2 > 0.999999
    vifs = {r.feature: r.vif for r in regress.vif(df.where("y IS NOT NULL"), ["x", "z"]).collect()}
    x = np.array([[r[0], r[1]] for r in rows])
    g = x.T @ x
    assert np.allclose([vifs["x"], vifs["z"]], np.diag(g) * np.diag(np.linalg.inv(g)))


def test_feature_scores_of_a_small_spread_on_a_large_mean(spark):
    from reviewlab.operators.features import feature_engineering
    df = spark.createDataFrame([(i, f"d{i % 3}", 10 ** 9 + i % 5) for i in range(60)], "id long, drugName string, usefulCount long")
    got = [r["usefulStandardized"] for r in feature_engineering(df, categorical=("drugName",)).orderBy("id").collect()]
    x = np.array([i % 5 for i in range(60)], float)
    assert np.allclose(got, (x - x.mean()) / x.std(ddof=1), atol=1e-6)


def test_folds_keep_rows_without_a_label(spark):
    from reviewlab.operators.sampling import stratified_folds
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "id long, label int")
    got = stratified_folds(df, "label", 5)
    assert got.count() == 100 and got.where("fold IS NULL").count() == 0
    sizes = {tuple(r[:2]): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    assert max(sizes.values()) - min(v for (label, _), v in sizes.items() if label is not None) <= 9


def test_document_vectors_keep_texts_without_known_words(spark):
    from reviewlab.operators.embed import document_vectors
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "zzz"), (4, None)], "id long, review string")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 5.0])], "word string, vector array<double>")
    got = {r["id"]: (r["emb1"], r["emb2"]) for r in document_vectors(docs, vectors, size=2).collect()}
    assert got == {1: (2.0, 3.0), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_cluster_indices_without_a_second_cluster(spark):
    pts = spark.createDataFrame([(i, [float(i)], 0, 0) for i in range(4)], "id long, v array<double>, cluster int, truth int")
    assert cluster.calinski_harabasz(pts).first()[0] is None and cluster.davies_bouldin(pts).first()[0] is None
    assert cluster.adjusted_rand(pts.limit(1), "truth", "cluster").first()[0] == 1.0


def test_many_centres_are_joined_not_refused(spark, monkeypatch):
    monkeypatch.setattr(cluster, "LITERAL_CENTRES", 2)
    pts = spark.createDataFrame([(i, [float(i)]) for i in range(20)], "id long, v array<double>")
    centres = spark.createDataFrame([(k, [4.0 * k]) for k in range(5)], "cluster long, c array<double>")
    got = {r["id"]: r["cluster"] for r in cluster.assign_to_centres(pts, centres).collect()}
    assert got == {i: min(range(5), key=lambda k: (abs(i - 4 * k), k)) for i in range(20)}


def test_condition_with_an_end_mark_is_taken_literally(spark):
    from pyspark.sql import functions as F

    from reviewlab.functions.text import condition_pattern
    df = spark.createDataFrame([("x a\\Eb y", "a\\Eb"), ("x aXb y", "a.b"), ("x a.b y", "a.b"), ("x a\\E.b y", "a\\E.b")], "t string, c string")
    got = [r[0] for r in df.select(F.regexp_like("t", condition_pattern(F.col("c")))).collect()]
    assert got == [True, False, True, True]


def test_lexicon_join_matches_the_literal_map(spark):
    from reviewlab.operators import sentiment as se
    lex = {"good": 2.0, "bad": -1.5, "fine": 1.0}
    docs = spark.createDataFrame([(1, "Good good BAD x"), (2, ""), (3, None), (4, "fine bad bad")], "id long, review string")
    table = spark.createDataFrame(list(lex.items()), "word string, valence double")
    joined = {r["id"]: r["valence"] for r in se.lexicon_scores_join(docs, table).collect()}
    literal = {r["id"]: r["v"] for r in docs.select("id", se.valence_sum(docs["review"], lex).alias("v")).collect()}
    assert joined == {1: 2.5, 2: 0.0, 3: 0.0, 4: -2.0} and all(joined[i] == (v or 0.0) for i, v in literal.items())


def test_batch_scorer_is_loaded_once_a_task_and_sees_bounded_batches(spark):
    from reviewlab.operators import sentiment as se

    def load():
        calls = []

        def run(texts):
            calls.append(len(texts))
            assert len(texts) <= 3
            return texts.fillna("").str.len() + 1000 * (len(calls) == 0)
        return run

    docs = spark.createDataFrame([(i, "w " * i) for i in range(20)], "id long, review string").coalesce(1)
    got = {r["id"]: r["sentiment"] for r in se.score_sentiment(docs, loader=load, batch_rows=3).collect()}
    assert got == {i: 2 * i for i in range(20)}
    cut = {r["id"]: r["sentiment"] for r in se.score_sentiment(docs, loader=load, batch_rows=3, max_tokens=2).collect()}
    assert cut[19] == 3


def test_pruned_tree_leaves_are_numbered_as_mllib_numbers_them(spark):
    from reviewlab.operators import classify as cf
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), int(a + b > 1), i % 5) for i, (a, b) in enumerate(rng.random((200, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int, fold int")
    scored, curve, alpha = cf.tree_postprune(df, df, ["a", "b"], impurities=("gini",), subsets=("all",), max_depth=6)
    acc = np.mean([r["prediction"] == r["label"] for r in scored.collect()])
    assert acc > 0.9 and scored.count() == 200 and alpha in [a for a, _ in curve]
    assert [a for a, _ in curve] == sorted(a for a, _ in curve) and max(x for _, x in curve) > 0.85
