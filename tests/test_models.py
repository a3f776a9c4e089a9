"""Tuned models: gradients, the kNN classifier, the whole classification run's parts."""

import numpy as np

from reviewlab.operators import classify, perceptron
from reviewlab.operators.sampling import stratified_folds


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    net = perceptron.Network([4, 7, 5, 1])
    w, x, y = net.first(1) + 0.1 * rng.normal(size=net.count), rng.normal(size=(30, 4)), rng.integers(0, 2, 30)
    g = net.gradient(w, x, y)
    for i in rng.choice(net.count, 25, replace=False):
        step = np.zeros(net.count)
        step[i] = 1e-6
        assert abs((net.loss(w + step, x, y) - net.loss(w - step, x, y)) / 2e-6 - g[i]) < 1e-4 * (1 + abs(g[i]))


def _rows(spark, n=400, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [1, 1000] + [0, 5000]  # of very different size
    y = ((x[:, 0] ** 2 + ((x[:, 1] - 5000) / 1000) ** 2) < 1.2).astype(int)  # a disc: not linear
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    return df.where("id % 4 <> 0"), df.where("id % 4 = 0")


def test_summed_gradient_does_not_depend_on_partitions(spark):
    train, _ = _rows(spark)
    from pyspark.sql import functions as F
    rows = train.select(F.array("a", (F.col("b") / 1000)).alias("x"), F.col("label").cast("double").alias("y"))
    net = perceptron.Network([2, 8, 1])
    one, n = perceptron.gradient_sum(rows.coalesce(1), net, net.first(3))
    many, m = perceptron.gradient_sum(rows.repartition(7), net, net.first(3))
    assert n == m == 300 and np.allclose(one, many)
    x, y = (np.array(v) for v in zip(*[(r.x, r.y) for r in rows.collect()]))
    assert np.allclose(one, net.gradient(net.first(3), x, y) / 300)


def test_network_learns_what_is_not_linear_and_repeats(spark):
    train, test = _rows(spark)
    scored, curve = perceptron.mlp(train, test, ["a", "b"], epochs=20, steps=4, hidden=(32, 16))
    got = sorted((r.id, r.label, r.prediction, round(r.probability, 9)) for r in scored.collect())
    assert len(got) == 100 and len(curve) == 20 and curve[-1][1] > curve[0][1]
    again = perceptron.mlp(train, test, ["a", "b"], epochs=3, steps=4, hidden=(32, 16))[1]
    assert np.allclose([a for _, a in again], [a for _, a in curve[:3]])
    assert perceptron.mlp(train.withColumn("a", train["a"] * 0), test, ["a", "b"], epochs=1, steps=2)[0].count() == 100


def test_knn_classifier(spark):
    train, test = _rows(spark, 240)
    train = stratified_folds(train, "label", 5)
    scored, (k, metric, weights), table = classify.knn(train, test, ["a", "b"], k_max=30)
    rows = scored.collect()
    assert len(rows) == 60 and 1 <= k <= 30 and (metric, weights) in {(r.metric, r.weights) for r in table.collect()}
    assert table.count() == 20


def test_preparation_writes_texts_once(spark, monkeypatch):
    from reviewlab import session
    from reviewlab.operators import balance
    from reviewlab.plans import workflows
    from reviewlab.sources.fixtures import reviews_doc
    from tests.conftest import SMALL
    texts = []
    real = type(spark.range(0)).checkpoint
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", lambda self, *a, **k: texts.append(self.columns) or real(self, *a, **k))
    monkeypatch.setattr(workflows, "stash", lambda df, name: texts.append(df.columns) or session.stash(df, name), raising=False)
    monkeypatch.setattr(workflows, "remove_outliers", lambda df, *a: df)
    monkeypatch.setattr(balance, "balance", lambda df, features, label, k: df.select("id", *features, label))
    train, test, report = workflows.prepare(reviews_doc(spark, SMALL), select=False)
    assert sum("review" in columns for columns in texts) == 1
    assert train.columns == test.columns == ["id", *workflows.FEATURES, "rating"] and train.count() and set(report) == {"vif", "high_vif", "correlation", "covariance"}
