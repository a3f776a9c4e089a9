"""Slice 8: classifiers on the labelled-document features."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import classify as cf
from reviewlab.operators import evaluate as ev
from reviewlab.operators.perceptron import mlp
from reviewlab.operators.sampling import stratified_folds
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.session import cut_lineage
from reviewlab.sources.fixtures import features_doc, features_doc_sql, split_bucket, split_bucket_sql

FEATS = ["word_count", "upper_count", "useful"]


def _split(spark, sf):
    """Train (with folds) and test features, written once to the checkpoint
    folder: iterative fitters then re-read a few numeric columns instead of
    re-deriving them from the raw text on every iteration."""
    fd = cut_lineage(features_doc(spark, sf))
    b = split_bucket("id")
    train = cut_lineage(stratified_folds(fd.where(b != 0), "label", 5))
    return train, fd.where(b == 0)


def _report(spark, name, scored):
    m = ev.classification_metrics(scored).first()
    auc = ev.roc_auc(scored).first()[0]
    return spark.createDataFrame([(name, m["precision"], m["recall"], m["specificity"], m["f1"], m["accuracy"],
                                   float(auc) if auc is not None else None)],
                                 "model string, precision double, recall double, specificity double, f1 double, "
                                 "accuracy double, auc double")


def _nb_sql() -> str:
    v = " + ".join(f"- 0.5 * ln(2 * pi() * (st.v_{c} + ev.eps)) - (te.{c} - st.m_{c}) * (te.{c} - st.m_{c}) / (2 * (st.v_{c} + ev.eps))"
                   for c in FEATS).replace("+ -", "-")
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in FEATS)
    return f"""WITH fd AS ({features_doc_sql()}),
tr AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} <> 0), te AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} = 0),
st AS (SELECT label, count(*) AS n, {stats} FROM tr GROUP BY label),
ev AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in FEATS)}) AS eps FROM tr),
tot AS (SELECT count(*) AS n FROM tr),
j AS (SELECT te.id, st.label, ln(st.n / tot.n) {v} AS jll FROM te, st, ev, tot),
mx AS (SELECT id, max(jll) AS mx FROM j GROUP BY id),
pr AS (SELECT j.id, sum(exp(j.jll - mx.mx)) AS den, sum(CASE WHEN j.label = 1 THEN exp(j.jll - mx.mx) ELSE 0 END) AS num
       FROM j JOIN mx ON j.id = mx.id GROUP BY j.id),
top AS (SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY jll DESC, label) AS rn FROM j) WHERE rn = 1)
SELECT pr.id, CAST(top.label AS INTEGER) AS prediction, {r_sql('num / den')} AS probability
FROM pr JOIN top ON pr.id = top.id"""


@register("doc_naive_bayes_fixed", _nb_sql())
def doc_naive_bayes_fixed(spark, sf):
    """CLS-8 with smoothing 1e-9: per-class aggregates, log densities as Columns."""
    fd = features_doc(spark, sf)
    b = split_bucket("id")
    model = cf.fit_gaussian_nb(fd.where(b != 0), FEATS, "label", 1e-9)
    p = cf.nb_predict(fd.where(b == 0), model)
    return p.select("id", "prediction", rnd("probability").alias("probability"))


@register("doc_naive_bayes")
def doc_naive_bayes(spark, sf):
    """CLS-1 + CLS-8: smoothing tuned by stratified 5-fold accuracy; test metrics."""
    train, test = _split(spark, sf)
    scored, _ = cf.naive_bayes(train, test, FEATS)
    return _report(spark, "gaussian_nb", scored)


@register("doc_tree_preprune")
def doc_tree_preprune(spark, sf):
    """CLS-1 + CLS-2: pre-pruned tree, the whole grid."""
    train, test = _split(spark, sf)
    scored, _ = cf.tree_preprune(train, test, FEATS)
    return _report(spark, "tree_preprune", scored)


@register("doc_tree_postprune")
def doc_tree_postprune(spark, sf):
    """CLS-3: cost-complexity pruning paths; criterion, feature subset and alpha by 5-fold accuracy."""
    train, test = _split(spark, sf)
    scored, _, _ = cf.tree_postprune(train, test, FEATS)
    return _report(spark, "tree_postprune", scored)


@register("doc_logistic")
def doc_logistic(spark, sf):
    """CLS-4: logistic regression, C and iterations tuned."""
    train, test = _split(spark, sf)
    scored, _ = cf.logistic(train, test, FEATS)
    return _report(spark, "logistic", scored)


@register("doc_svm")
def doc_svm(spark, sf):
    """CLS-7: linear, polynomial and RBF-feature SVMs compared; the linear and the best one."""
    train, test = _split(spark, sf)
    linear, _, best = cf.svm(train, test, FEATS)
    return _report(spark, "svm_linear", linear).unionByName(_report(spark, "svm_best", best))


@register("doc_mlp")
def doc_mlp(spark, sf):
    """CLS-9 + CLS-10: network of 64 and 32 units, mini-batch Adam, the best of 30 epochs on the tail 20 %."""
    train, test = _split(spark, sf)
    scored, _ = mlp(train, test, FEATS)
    return _report(spark, "mlp", scored)
