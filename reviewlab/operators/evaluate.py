"""Classifier evaluation on a (label, prediction, probability) DataFrame
(EVAL-1..6, CLS-11).  Every metric is an aggregate; the ROC curve uses
distributed running sums over the distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.indexing import running_sums


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction", classes=(0, 1)) -> DataFrame:
    """EVAL-2: one row per (true, predicted) cell, zero-filled."""
    counts = df.groupBy(F.col(label).cast("int").alias("true_label"),
                        F.col(pred).cast("int").alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    lits = [F.lit(int(c)) for c in classes]
    cells = spark.range(1).select(F.explode(F.array(*lits)).alias("true_label")).select(
        "true_label", F.explode(F.array(*lits)).alias("pred_label"))
    return (F.broadcast(cells).join(counts, ["true_label", "pred_label"], "left")
            .select("true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EVAL-3/EVAL-4: precision, recall, specificity, F1, accuracy (0 when undefined)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
               F.count(F.lit(1)).alias("n"))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(
        prec.alias("precision"), rec.alias("recall"),
        _ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        _ratio(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """CLS-11."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def _score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("n_pos"),
        F.sum((F.col(label) != 1).cast("long")).alias("n_neg"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability",
              drop_intermediate: bool = True) -> DataFrame:
    """EVAL-5: exact ROC points (fpr, tpr, threshold) as in scikit-learn,
    including the leading (0, 0, +inf) point and dropping collinear points."""
    st = _score_table(df, label, score)
    rs = running_sums(st, ["threshold"], ["n_pos", "n_neg"], ascending=False, index_col="i")
    tot = st.agg(F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"), F.count(F.lit(1)).alias("K")).first()
    pts = rs.select("i", "threshold", F.col("cum_n_pos").alias("tps"), F.col("cum_n_neg").alias("fps"))
    if drop_intermediate and tot["K"] > 2:
        nb = pts.select((F.col("i") + 1).alias("i"), F.col("tps").alias("tps_prev"), F.col("fps").alias("fps_prev"))
        na = pts.select((F.col("i") - 1).alias("i"), F.col("tps").alias("tps_next"), F.col("fps").alias("fps_next"))
        j = pts.join(nb, "i", "left").join(na, "i", "left")
        keep = (F.col("tps_prev").isNull() | F.col("tps_next").isNull()
                | (F.col("fps_next") - 2 * F.col("fps") + F.col("fps_prev") != 0)
                | (F.col("tps_next") - 2 * F.col("tps") + F.col("tps_prev") != 0))
        pts = j.where(keep).select("i", "threshold", "tps", "fps")
    first = df.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("i"),
                                            F.lit(float("inf")).alias("threshold"),
                                            F.lit(0.0).alias("tps"), F.lit(0.0).alias("fps"))
    allp = first.unionByName(pts.select("i", "threshold", F.col("tps").cast("double"), F.col("fps").cast("double")))
    P, N = float(tot["P"] or 0), float(tot["N"] or 0)
    fpr = (F.col("fps") / F.lit(N)) if N else F.lit(float("nan"))
    tpr = (F.col("tps") / F.lit(P)) if P else F.lit(float("nan"))
    return allp.select((F.col("i") + 1).alias("point"), fpr.alias("fpr"), tpr.alias("tpr"), "threshold")


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """EVAL-6: area under the ROC curve with ties (= trapezoids over distinct scores)."""
    st = _score_table(df, label, score)
    rs = running_sums(st, ["threshold"], ["n_pos"], ascending=False, index_col="i")
    # positives ranked strictly above this score: cum_n_pos - n_pos
    area = rs.agg(F.sum(F.col("n_neg") * (F.col("cum_n_pos") - F.col("n_pos") / 2.0)).alias("a"),
                  F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))
    return area.select((F.col("a") / (F.col("P") * F.col("N"))).alias("auc"))


def evaluate(df: DataFrame, label: str = "label", pred: str = "prediction", score: str = "probability"):
    """EVAL-1: all evaluations for one model, as a dict of DataFrames."""
    return {"confusion": confusion_matrix(df, label, pred),
            "metrics": classification_metrics(df, label, pred),
            "roc": roc_curve(df, label, score),
            "auc": roc_auc(df, label, score)}
