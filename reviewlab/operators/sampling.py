"""Splits and folds without row position (SMP-1..3, SET-1, LIM-1).

All of them are deterministic functions of the id, so a retried task or a
lost executor recomputes exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.indexing import ordered_index
from reviewlab.sources.fixtures import split_bucket


def train_test_split(df: DataFrame, id_col: str = "id", test_bucket: int = 0):
    """SMP-1: 80/20 by an md5 bucket of the id (bucket 0 = test)."""
    b = split_bucket(id_col)
    return df.where(b != test_bucket), df.where(b == test_bucket)


def holdout_tail(df: DataFrame, frac: float = 0.2, order: str = "id", out: str = "is_validation") -> DataFrame:
    """SMP-2: flag the last ``frac`` of rows in ``order`` (keras validation_split).

    keras keeps the first ``int(n * (1 - frac))`` rows for training.
    """
    keys = ordered_index(df.select(order), [order], out="_pos")
    n = keys.count()
    cut = int(n * (1.0 - frac))
    flags = keys.select(order, (F.col("_pos") >= cut).cast("int").alias(out))
    return df.join(flags, order, "left")


def stratified_folds(df: DataFrame, label: str = "label", k: int = 5, order: str = "id",
                     out: str = "fold") -> DataFrame:
    """SMP-3: ``ntile(k) OVER (PARTITION BY label ORDER BY id) - 1`` without
    putting a whole class into one task: a global ordinal on (label, id) minus
    the class start gives the rank inside the class; ``ntile`` is arithmetic."""
    keys = ordered_index(df.select(label, order), [label, order], out="_pos")
    sizes = keys.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_start"))
    # rows without a label are a class of their own, so the joins are null-safe
    j = keys.join(sizes, F.col(label).eqNullSafe(F.col("_label")))
    i = F.col("_pos") - F.col("_start")
    q = F.floor(F.col("_n") / k)
    r = F.col("_n") % k
    big = (q + 1) * r
    fold = F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / F.greatest(q, F.lit(1))))
    folds = j.select(F.col(order).alias("_order"), fold.cast("int").alias(out))
    return df.join(folds, df[order].eqNullSafe(F.col("_order")), "left").drop("_order")


def union_in_order(first: DataFrame, second: DataFrame, tag: str = "src") -> DataFrame:
    """SET-1: union by name, the first frame's rows ordered before the second's."""
    return (first.withColumn(tag, F.lit(0)).unionByName(second.withColumn(tag, F.lit(1))))


def head(df: DataFrame, n: int = 5, order: str = "id") -> DataFrame:
    """LIM-1: the first rows in id order (a top-n, not a sample)."""
    return df.orderBy(order).limit(n)
