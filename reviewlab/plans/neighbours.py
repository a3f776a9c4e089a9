"""Slice 5: kNN join and its users (kNN classifiers, SMOTE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import balance as bl
from reviewlab.operators import knn
from reviewlab.operators.sampling import stratified_folds
from reviewlab.operators.stats import arg_extreme
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.session import stash
from reviewlab.sources.fixtures import (
    VECTORS_EMB_SQL, features_doc, features_doc_sql, split_bucket, split_bucket_sql, vectors_emb,
)

FEATS = ["word_count", "upper_count", "useful"]
EMB = f"""WITH e AS ({VECTORS_EMB_SQL}),
te AS (SELECT * FROM e WHERE {split_bucket_sql('id')} = 0), tr AS (SELECT * FROM e WHERE {split_bucket_sql('id')} <> 0)
"""


def _fd_cte(metric: str = "euclidean") -> str:
    if metric == "euclidean":
        dist = "sqrt(" + " + ".join(f"(te.{c} - tr.{c}) * (te.{c} - tr.{c})" for c in FEATS) + ")"
    else:
        dist = " + ".join(f"abs(te.{c} - tr.{c})" for c in FEATS)
    return f"""WITH fd AS ({features_doc_sql()}),
te AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} = 0), tr AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} <> 0),
d AS (SELECT te.id AS qid, tr.id AS rid, tr.label AS nlabel, {dist} AS dist FROM te, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), rid) AS rk FROM d)
"""


def _fd_split(spark, sf):
    fd = features_doc(spark, sf)
    b = split_bucket("id")
    return fd.where(b != 0), fd.where(b == 0)


def _vec(df):
    return df.select("id", knn.as_vector(FEATS).alias("v"), "label")


@register("emb_knn", EMB + f"""
, d AS (SELECT te.id AS qid, tr.id AS rid, list_distance(te.v, tr.v) AS dist FROM te, tr)
SELECT qid, rid, CAST(rk AS INTEGER) AS rank, {r_sql('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), rid) AS rk FROM d) WHERE rk <= 5""")
def emb_knn(spark, sf):
    """JN-7: exact 5 nearest train vectors (64-d) for every test vector."""
    e = vectors_emb(spark, sf)
    b = split_bucket("id")
    nn = knn.knn_join(e.where(b == 0), e.where(b != 0), 5)
    return nn.select("qid", "rid", F.col("rank").cast("int").alias("rank"), rnd("dist").alias("dist"))


K_SWEEP = 250
SWEEP_SQL = _fd_cte() + f"""
, nb AS (SELECT * FROM r WHERE rk <= {K_SWEEP})
, ks AS (SELECT DISTINCT rk AS k FROM nb)
, cnt AS (SELECT nb.qid, ks.k, nb.nlabel, count(*) AS c FROM nb JOIN ks ON nb.rk <= ks.k GROUP BY nb.qid, ks.k, nb.nlabel)
, pred AS (SELECT qid, k, nlabel AS pred FROM (
    SELECT *, row_number() OVER (PARTITION BY qid, k ORDER BY c DESC, nlabel) AS rn FROM cnt) WHERE rn = 1)
, curve AS (SELECT k, avg(CAST(pred.pred = te.label AS DOUBLE)) AS accuracy FROM pred JOIN te ON pred.qid = te.id GROUP BY k)
"""


def _curve(spark, sf):
    tr, te = _fd_split(spark, sf)
    nn = knn.knn_join(_vec(te), _vec(tr), K_SWEEP)
    return knn.knn_vote_curve(nn, te, tr)


@register("doc_knn_k_sweep", SWEEP_SQL + f"SELECT CAST(k AS INTEGER) AS k, {r_sql('accuracy')} AS accuracy FROM curve")
def doc_knn_k_sweep(spark, sf):
    """CLS-5: test accuracy for every k = 1..250 from one 250-neighbour join."""
    return _curve(spark, sf).select(F.col("k").cast("int").alias("k"), rnd("accuracy").alias("accuracy"))


@register("doc_knn_best_k", SWEEP_SQL + f"""
SELECT CAST(k AS INTEGER) AS k, {r_sql('accuracy')} AS accuracy FROM curve ORDER BY accuracy DESC, k LIMIT 1""")
def doc_knn_best_k(spark, sf):
    """CLS-5 + AGG-9: the first k with the best accuracy."""
    c = _curve(spark, sf).withColumn("id", F.col("k")).withColumn("g", F.lit(1))
    best = arg_extreme(c, "g", "accuracy", "k")
    return best.select(F.col("k").cast("int").alias("k"), rnd("accuracy").alias("accuracy"))


def _knn_pred_sql(metric: str, weights: str, k: int = 5) -> str:
    w = ("CASE WHEN z.hz = 1 THEN CAST(nb.dist = 0 AS DOUBLE) ELSE 1.0 / nb.dist END"
         if weights == "distance" else "1.0")
    return _fd_cte(metric) + f"""
, nb AS (SELECT * FROM r WHERE rk <= {k})
, z AS (SELECT qid, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) AS hz FROM nb GROUP BY qid)
, w AS (SELECT nb.qid, nb.nlabel, {w} AS w FROM nb JOIN z ON nb.qid = z.qid)
, a AS (SELECT qid, sum(CASE WHEN nlabel = 1 THEN w ELSE 0.0 END) AS w1, sum(w) AS wt FROM w GROUP BY qid)
SELECT qid, {r_sql('w1 / wt')} AS probability, CAST(w1 > wt - w1 AS INTEGER) AS prediction FROM a"""


def _knn_pred(spark, sf, metric, weights, k=5):
    tr, te = _fd_split(spark, sf)
    nn = knn.knn_join(_vec(te), _vec(tr), k, metric=metric)
    p = knn.knn_predict(nn, tr, weights)
    return p.select("qid", rnd("probability").alias("probability"), "prediction")


@register("doc_knn_uniform_euclidean", _knn_pred_sql("euclidean", "uniform"))
def doc_knn_uniform_euclidean(spark, sf):
    """CLS-6: uniform weights, euclidean metric, class-1 probability."""
    return _knn_pred(spark, sf, "euclidean", "uniform")


@register("doc_knn_distance_manhattan", _knn_pred_sql("manhattan", "distance"))
def doc_knn_distance_manhattan(spark, sf):
    """CLS-6: inverse-distance weights, manhattan metric."""
    return _knn_pred(spark, sf, "manhattan", "distance")


@register("doc_knn_uniform_manhattan", _knn_pred_sql("manhattan", "uniform"))
def doc_knn_uniform_manhattan(spark, sf):
    """CLS-6: uniform weights, manhattan metric."""
    return _knn_pred(spark, sf, "manhattan", "uniform")


@register("doc_knn_distance_euclidean", _knn_pred_sql("euclidean", "distance"))
def doc_knn_distance_euclidean(spark, sf):
    """CLS-6: inverse-distance weights, euclidean metric."""
    return _knn_pred(spark, sf, "euclidean", "distance")


TUNE_K = 15


def _tuning_cte() -> str:
    """Votes of the TUNE_K nearest rows outside the own fold, for every candidate of the search."""
    euclid = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS) + ")"
    city = " + ".join(f"abs(a.{c} - b.{c})" for c in FEATS)
    return f"""WITH fd AS ({features_doc_sql()}),
fo AS (SELECT *, ntile(5) OVER (PARTITION BY label ORDER BY id) - 1 AS fold FROM fd WHERE {split_bucket_sql('id')} <> 0),
d AS (SELECT m.metric, a.id AS qid, a.fold, a.label, b.id AS rid, b.label AS nlabel,
             CASE WHEN m.metric = 'euclidean' THEN {euclid} ELSE {city} END AS dist
      FROM fo a JOIN fo b ON a.fold <> b.fold, (SELECT unnest(['euclidean', 'manhattan']) AS metric) m),
nb AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY metric, qid ORDER BY round(dist, 9), rid) <= {TUNE_K}),
z AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY metric, qid) AS hz FROM nb),
w AS (SELECT z.*, x.weights, CASE WHEN x.weights = 'uniform' THEN 1.0::DOUBLE WHEN hz = 1 THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0 / dist END AS w
      FROM z, (SELECT unnest(['uniform', 'distance']) AS weights) x),
v AS (SELECT metric, weights, fold, qid, label, sum(CASE WHEN nlabel = 1 THEN w ELSE 0.0 END) AS w1, sum(w) AS wt FROM w GROUP BY ALL),
acc AS (SELECT metric, weights, CAST(fold AS INTEGER) AS fold, count(*) AS n,
               avg(CAST(CAST(w1 > wt - w1 AS INTEGER) = label AS DOUBLE)) AS accuracy FROM v GROUP BY ALL)
"""


def _folded(spark, sf):
    tr, te = _fd_split(spark, sf)
    return stratified_folds(_vec(tr), "label", 5), te


@register("doc_knn_tuning", _tuning_cte() + f"SELECT metric, weights, fold, n, {r_sql('accuracy')} AS accuracy FROM acc")
def doc_knn_tuning(spark, sf):
    """CLS-6: the 5-fold search over weights and metric, every fold's accuracy of every candidate."""
    train, _ = _folded(spark, sf)
    t = knn.tuned_votes(train, TUNE_K)
    return t.select("metric", "weights", F.col("fold").cast("int").alias("fold"), "n", rnd("accuracy").alias("accuracy"))


@register("doc_knn_tuned", _tuning_cte() + f""",
me AS (SELECT metric, weights, avg(accuracy) AS mean FROM acc GROUP BY ALL),
best AS (SELECT metric, weights, mean FROM me ORDER BY round(mean, 12) DESC, metric, weights DESC LIMIT 1)
SELECT metric, weights, {r_sql('mean')} AS mean_accuracy FROM best""")
def doc_knn_tuned(spark, sf):
    """CLS-6: the candidate of the highest mean accuracy, the first of equals."""
    train, _ = _folded(spark, sf)
    table = stash(knn.tuned_votes(train, TUNE_K), "knn-tuning")
    metric, weights = knn.best_votes(table)
    mine = table.where((F.col("metric") == metric) & (F.col("weights") == weights))
    return mine.groupBy("metric", "weights").agg(rnd(F.avg("accuracy")).alias("mean_accuracy"))


@register("emb_knn_ties", EMB + f"""
, g AS (SELECT id, [floor(x * 2) FOR x IN v[1:6]] AS v FROM e)
, d AS (SELECT te.id AS qid, tr.id AS rid, list_distance(te.v, tr.v) AS dist FROM g te, g tr
        WHERE {split_bucket_sql('te.id')} = 0 AND {split_bucket_sql('tr.id')} <> 0)
SELECT qid, rid, CAST(rk AS INTEGER) AS rank, {r_sql('dist')} AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), rid) AS rk FROM d) WHERE rk <= 5""")
def emb_knn_ties(spark, sf):
    """JN-7 on coarse coordinates: most distances tie, and ties go to the smaller id."""
    e = vectors_emb(spark, sf)
    g = e.select("id", F.transform(F.slice("v", 1, 6), lambda x: F.floor(x * 2).cast("double")).alias("v"))
    b = split_bucket("id")
    nn = knn.knn_join(g.where(b == 0), g.where(b != 0), 5)
    return nn.select("qid", "rid", F.col("rank").cast("int").alias("rank"), rnd("dist").alias("dist"))


def _smote_sql() -> str:
    dist = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS) + ")"
    feats = ", ".join(f"{r_sql(f'a.{c} + hh.u * (b.{c} - a.{c})')} AS {c}" for c in FEATS)
    return f"""WITH fd AS ({features_doc_sql()}),
tr AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} <> 0),
cc AS (SELECT label, count(*) AS n FROM tr GROUP BY label),
mn AS (SELECT label, n FROM cc ORDER BY n, label LIMIT 1),
mx AS (SELECT max(n) AS n FROM cc),
mino AS (SELECT tr.* FROM tr JOIN mn ON tr.label = mn.label),
ords AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS o FROM mino),
nd AS (SELECT mx.n - mn.n AS need, mn.n AS nmin FROM mx, mn),
smp AS (SELECT sid, sid % nmin AS o FROM (SELECT unnest(generate_series(0, need - 1)) AS sid, nmin FROM nd)),
hk AS (SELECT smp.sid, ords.id, CAST(ords.id AS VARCHAR) || ':' || CAST(smp.sid AS VARCHAR) AS key
       FROM smp JOIN ords ON smp.o = ords.o),
hh AS (SELECT sid, id, (('0x' || substr(md5(key), 1, 8))::BIGINT % 2) + 1 AS rk,
              ('0x' || substr(md5(key), 9, 8))::BIGINT / 4294967296.0 AS u FROM hk),
d AS (SELECT a.id AS qid, b.id AS rid, {dist} AS dist FROM mino a, mino b WHERE a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), rid) AS rk FROM d)
SELECT hh.sid, hh.id AS src_id, r.rid AS nb_id, {r_sql('hh.u')} AS u, {feats}, (SELECT label FROM mn) AS label
FROM hh JOIN r ON r.qid = hh.id AND r.rk = hh.rk JOIN mino a ON a.id = hh.id JOIN mino b ON b.id = r.rid"""


@register("doc_smote", _smote_sql())
def doc_smote(spark, sf):
    """BAL-1: deterministic SMOTE (k = 2) rows for the training split's minority class."""
    tr, _ = _fd_split(spark, sf)
    s = bl.smote(tr, FEATS, "label", k=2)
    return s.select("sid", "src_id", "nb_id", rnd("u").alias("u"), *[rnd(c).alias(c) for c in FEATS], "label")


@register("doc_balanced_counts", f"""WITH fd AS ({features_doc_sql()}),
tr AS (SELECT * FROM fd WHERE {split_bucket_sql('id')} <> 0),
cc AS (SELECT label, count(*) AS n FROM tr GROUP BY label)
SELECT label, (SELECT max(n) FROM cc) AS n FROM cc""")
def doc_balanced_counts(spark, sf):
    """BAL-1: class sizes after balancing (all equal to the majority)."""
    tr, _ = _fd_split(spark, sf)
    return bl.class_counts(bl.balance(tr, FEATS, "label", k=2), "label")
