"""Slice 3: evaluation on a deterministic score table, and sentiment reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.functions.encode import threshold
from reviewlab.operators import evaluate as ev
from reviewlab.operators import sentiment as se
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.plans.sqltext import tokens_sql
from reviewlab.sources.fixtures import REVIEWS_DOC_SQL, SCORES_SQL, reviews_doc, scores

SC = f"WITH s AS ({SCORES_SQL})\n"
LEX_SQL = "lex(w, v) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in se.DEFAULT_LEXICON.items()) + ")"
SENT_CTE = f"""WITH r AS ({REVIEWS_DOC_SQL}), {LEX_SQL},
t AS (SELECT id, unnest({tokens_sql('lower(review)')}) AS w FROM r),
sc AS (SELECT t.id, sum(lex.v) AS s, max(CASE WHEN lex.v > 0 THEN 1 ELSE 0 END) AS pos
       FROM t JOIN lex ON t.w = lex.w GROUP BY t.id),
sent AS (SELECT r.id, r.rating,
           CAST(CASE WHEN coalesce(sc.s, 0) > 0 THEN 2 WHEN coalesce(sc.s, 0) < 0 THEN 0 ELSE 1 END AS INTEGER) AS sentiment,
           CAST(coalesce(sc.pos, 0) AS INTEGER) AS has_positive
         FROM r LEFT JOIN sc ON r.id = sc.id)
"""


@register("scores_confusion", SC + """
, cells AS (SELECT a AS true_label, b AS pred_label FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b))
SELECT cells.true_label, cells.pred_label, CAST(count(s.id) AS BIGINT) AS n
FROM cells LEFT JOIN s ON s.label = cells.true_label AND s.prediction = cells.pred_label
GROUP BY cells.true_label, cells.pred_label""")
def scores_confusion(spark, sf):
    """EVAL-2."""
    return ev.confusion_matrix(scores(spark, sf))


@register("scores_metrics", SC + f"""
, c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) tn,
              count(*) n FROM s)
SELECT {r_sql('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END')} AS precision,
       {r_sql('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END')} AS recall,
       {r_sql('CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END')} AS specificity,
       {r_sql('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END')} AS f1,
       {r_sql('(tp + tn) / n')} AS accuracy FROM c""")
def scores_metrics(spark, sf):
    """EVAL-1, EVAL-3, EVAL-4."""
    m = ev.classification_metrics(scores(spark, sf))
    return m.select(*[rnd(c).alias(c) for c in m.columns])


@register("scores_accuracy", SC + f"""
SELECT {r_sql('avg(CAST(label = CAST(probability >= 0.5 AS INTEGER) AS DOUBLE))')} AS accuracy FROM s""")
def scores_accuracy(spark, sf):
    """FLT-9 then CLS-11: threshold the probability, then accuracy."""
    d = scores(spark, sf).withColumn("prediction", threshold("probability", 0.5))
    return ev.accuracy(d).select(rnd("accuracy").alias("accuracy"))


@register("scores_roc", SC + f"""
, st AS (SELECT probability AS threshold, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) n_pos,
                sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) n_neg FROM s GROUP BY probability)
, c AS (SELECT threshold, sum(n_pos) OVER w AS tps, sum(n_neg) OVER w AS fps,
               row_number() OVER (ORDER BY threshold DESC) - 1 AS i
        FROM st WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
, k AS (SELECT *, lag(tps) OVER (ORDER BY i) tp_prev, lead(tps) OVER (ORDER BY i) tp_next,
               lag(fps) OVER (ORDER BY i) fp_prev, lead(fps) OVER (ORDER BY i) fp_next FROM c)
, tot AS (SELECT sum(n_pos) P, sum(n_neg) N, count(*) K FROM st)
, pts AS (SELECT i, threshold, tps, fps FROM k, tot
          WHERE K <= 2 OR tp_prev IS NULL OR tp_next IS NULL OR fp_next - 2 * fps + fp_prev <> 0
             OR tp_next - 2 * tps + tp_prev <> 0
          UNION ALL SELECT -1, 'inf'::DOUBLE, 0, 0)
SELECT CAST(i + 1 AS BIGINT) AS point, {r_sql('fps / N')} AS fpr, {r_sql('tps / P')} AS tpr, threshold FROM pts, tot""")
def scores_roc(spark, sf):
    """EVAL-5: exact ROC points."""
    r = ev.roc_curve(scores(spark, sf))
    return r.select("point", rnd("fpr").alias("fpr"), rnd("tpr").alias("tpr"), "threshold")


@register("scores_auc", SC + f"""
SELECT {r_sql('(sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)'
              ' / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label <> 1))')} AS auc
FROM (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS r FROM s)""")
def scores_auc(spark, sf):
    """EVAL-6: ROC AUC with tied scores."""
    return ev.roc_auc(scores(spark, sf)).select(rnd("auc").alias("auc"))


def _sentiment(spark, sf):
    r = reviews_doc(spark, sf)
    return r.select("id", "rating", se.three_class(se.valence_sum(F.col("review"))).alias("sentiment"),
                    se.has_positive(F.col("review")).alias("has_positive"))


@register("doc_sentiment", SENT_CTE + "SELECT id, sentiment, has_positive FROM sent")
def doc_sentiment(spark, sf):
    """TXT-1, TXT-2, UDF-3 (lexicon scorer, JVM-side)."""
    return _sentiment(spark, sf).select("id", "sentiment", "has_positive")


@register("doc_sentiment_batch", SENT_CTE + "SELECT id, sentiment FROM sent")
def doc_sentiment_batch(spark, sf):
    """UDF-3: the same codes through the Arrow batch-scoring harness."""
    r = reviews_doc(spark, sf).select("id", "review")
    return se.score_sentiment(r, "review", scorer=se.lexicon_scorer()).select("id", "sentiment")


@register("doc_sentiment_confusion", SENT_CTE + """
, cells AS (SELECT a AS true_label, b AS pred_label FROM (VALUES (0), (1), (2)) x(a), (VALUES (0), (1), (2)) y(b))
, lab AS (SELECT CAST(CASE WHEN rating < 4 THEN 0 WHEN rating >= 4 AND rating <= 7 THEN 1 WHEN rating > 7 THEN 2 ELSE 0 END AS INTEGER) AS t,
                 sentiment AS p FROM sent)
SELECT cells.true_label, cells.pred_label, CAST(count(lab.t) AS BIGINT) AS n
FROM cells LEFT JOIN lab ON lab.t = cells.true_label AND lab.p = cells.pred_label
GROUP BY cells.true_label, cells.pred_label""")
def doc_sentiment_confusion(spark, sf):
    """TXT-3: rating band vs sentiment, zero-filled."""
    return se.sentiment_confusion(_sentiment(spark, sf))


@register("doc_sentiment_distribution", SENT_CTE + """
SELECT sentiment, count(*) AS n FROM sent GROUP BY sentiment ORDER BY sentiment""")
def doc_sentiment_distribution(spark, sf):
    """TXT-4."""
    return se.class_distribution(_sentiment(spark, sf), "sentiment")
