"""Global ordinals without a single-partition window (used by ENC-1, WIN-6, SMP-2, REG-2).

``row_number() OVER (ORDER BY k)`` runs in one task.  Here the keys are range
partitioned and sorted in parallel, each row takes a per-partition position
from ``monotonically_increasing_id`` and a per-partition offset is added from
a table with one row per partition.  The ranged data is checkpointed first so
the range bounds (found by sampling) cannot change between the two uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.session import cut_lineage

_LOW33 = (1 << 33) - 1


def ordered_index(df: DataFrame, order_cols, out: str = "idx", start: int = 0,
                  partitions: int | None = None) -> DataFrame:
    """Add ``out`` = position of each row in ``order_cols`` order (rows must be
    distinct on ``order_cols`` for a well-defined answer)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    pid = F.shiftright(F.col("_mid"), 33)
    sizes = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, safe to window and broadcast
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ranged.withColumn("_pid", pid)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW33)) + F.lit(start)).cast("bigint"))
            .drop("_pid", "_off", "_mid"))


def first_appearance(df: DataFrame, value: str, order: str = "id", out: str = "first_id") -> DataFrame:
    """WIN-6 helper: one row per non-null value with the smallest order key."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias(out))


def first_appearance_ordinal(df: DataFrame, value: str, order: str = "id", out: str = "ordinal") -> DataFrame:
    """WIN-6: 0-based ordinal of each distinct value in order of first appearance."""
    return ordered_index(first_appearance(df, value, order), ["first_id", value], out=out)


def running_sums(df: DataFrame, order_cols, sum_cols, ascending: bool = True,
                 prefix: str = "cum_", index_col: str = "pos") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_cols`` order, plus the
    global 0-based position, computed in parallel.

    The rows are range partitioned and sorted, checkpointed, summed inside
    each partition with ``mapInPandas`` (no shuffle), and shifted by the totals
    of the preceding partitions (a table with one row per partition).
    """
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    sum_cols = [sum_cols] if isinstance(sum_cols, str) else list(sum_cols)
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in order_cols]
    ranged = cut_lineage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                         .withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    tot = ranged.groupBy(pid.alias("_pid")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_on"),
                      *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    schema = T.StructType(list(ranged.schema.fields) + [T.StructField(f"_l_{c}", T.DoubleType()) for c in sum_cols])

    def local(batches):
        acc = {c: 0.0 for c in sum_cols}
        for pdf in batches:
            for c in sum_cols:
                v = pdf[c].astype("float64").fillna(0.0).to_numpy()
                cs = np.cumsum(v) + acc[c]
                acc[c] = float(cs[-1]) if len(cs) else acc[c]
                pdf[f"_l_{c}"] = cs
            yield pdf

    loc = ranged.mapInPandas(local, schema)
    out = (loc.withColumn("_pid", pid).join(F.broadcast(offs), "_pid")
           .withColumn(index_col, (F.col("_on") + F.col("_mid").bitwiseAND(F.lit(_LOW33))).cast("bigint")))
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_l_{c}") + F.col(f"_o_{c}"))
    return out.drop("_pid", "_on", "_mid", *[f"_l_{c}" for c in sum_cols], *[f"_o_{c}" for c in sum_cols])
