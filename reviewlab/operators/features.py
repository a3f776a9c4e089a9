"""Encoding, scaling and per-key features (ENC-1, MTH-1..3, WIN-1..4, PIPE-2).

Scalar statistics are *fitted* with one aggregate and applied as literals (the
estimator/transformer pattern), so applying them is a narrow projection with no
shuffle and no single-partition window.  Per-key statistics are grouped
aggregates (partial aggregation absorbs hot keys) joined back on the key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.indexing import ordered_index
from reviewlab.session import few


# ---------------------------------------------------------------- ENC-1
def fit_label_codes(df: DataFrame, col: str) -> DataFrame:
    """Dictionary (value, code): 0-based index in sorted distinct non-null values."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    return ordered_index(values, [col], out="_code").select(col, F.col("_code").cast("int").alias("_code"))


def apply_label_codes(df: DataFrame, col: str, codes: DataFrame) -> DataFrame:
    """Replace ``col`` by its code; unknown or null -> -1 (pandas ``cat.codes``).

    A dictionary of bounded size is broadcast: by their values, rows would meet in as few tasks as there are values."""
    joined = df.join(few(codes), col, "left")
    return joined.select(*[F.coalesce(F.col("_code"), F.lit(-1)).alias(c) if c == col else F.col(c)
                           for c in df.columns])


def label_encode(df: DataFrame, cols, fit_on: DataFrame | None = None) -> DataFrame:
    for c in ([cols] if isinstance(cols, str) else cols):
        df = apply_label_codes(df, c, fit_label_codes(fit_on if fit_on is not None else df, c))
    return df


# ---------------------------------------------------------------- MTH-1..3
def fit_moments(df: DataFrame, cols, ddof: int = 1) -> dict[str, tuple[float, float]]:
    """One aggregate for all columns: mean and standard deviation."""
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), std(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def _z(c: str, mean, sd, zero_sd_as_one: bool) -> Column:
    if mean is None:
        return F.lit(None).cast("double")
    if sd is None or sd == 0 or (isinstance(sd, float) and math.isnan(sd)):
        if zero_sd_as_one:
            return (F.col(c) - F.lit(mean)).cast("double")
        return F.lit(float("nan"))
    return ((F.col(c) - F.lit(float(mean))) / F.lit(float(sd))).cast("double")


def standardize(df: DataFrame, cols, ddof: int = 1, out: dict | None = None,
                fit_on: DataFrame | None = None) -> DataFrame:
    """MTH-1 (ddof 1, pandas) or MTH-3 (ddof 0, zero variance divides by 1)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = out or {}
    m = fit_moments(fit_on if fit_on is not None else df, cols, ddof)
    exprs = {out.get(c, c): _z(c, *m[c], zero_sd_as_one=(ddof == 0)) for c in cols}
    return df.withColumns(exprs)


def min_max_scale(df: DataFrame, cols, fit_on: DataFrame | None = None) -> DataFrame:
    """MTH-2: (x - min) / (max - min); a constant column maps to 0."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    src = fit_on if fit_on is not None else df
    row = src.agg(*[e for c in cols for e in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    exprs = {}
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        rng = (hi - lo) if (lo is not None and hi is not None) else None
        exprs[c] = (((F.col(c) - F.lit(lo)) / F.lit(rng)).cast("double") if rng
                    else (F.col(c) * 0).cast("double"))
    return df.withColumns(exprs)


# ---------------------------------------------------------------- WIN-1..4
def partition_mean(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """WIN-1: mean of ``value`` over the row's ``key`` group, on every row."""
    agg = df.groupBy(key).agg(F.avg(value).alias(out)).where(F.col(key).isNotNull())
    return df.join(agg, key, "left").select(*df.columns, out)


def partition_count(df: DataFrame, key: str, out: str) -> DataFrame:
    """WIN-2: size of the row's ``key`` group, on every row (null key -> null)."""
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).where(F.col(key).isNotNull())
    return df.join(agg, key, "left").select(*df.columns, out)


def review_quality(df: DataFrame, key: str = "drugName", value: str = "usefulCount",
                   out: str = "reviewQuality") -> DataFrame:
    """WIN-3: 1 when the row's value is above its group mean."""
    d = partition_mean(df, key, value, "_avg")
    return d.withColumn(out, F.coalesce((F.col(value) > F.col("_avg")), F.lit(False)).cast("int")).drop("_avg")


def review_frequency(df: DataFrame, key: str = "drugName", out: str = "reviewFrequency") -> DataFrame:
    """WIN-4: 1 when the group size is above the row-weighted mean group size.

    The row-weighted mean of group sizes is sum(n_k^2) / sum(n_k), computed from
    the per-key counts, so no second pass over the rows is needed.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col(key).isNotNull())
    tot = sizes.agg((F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).alias("_avg")).first()["_avg"]
    flags = sizes.select(key, (F.col("_n") > F.lit(tot)).cast("int").alias(out))
    return (df.join(flags, key, "left")
            .select(*df.columns, F.coalesce(F.col(out), F.lit(0)).alias(out)))


# ---------------------------------------------------------------- PIPE-2
def feature_engineering(df: DataFrame, categorical=("drugName", "condition", "date"),
                        key: str = "drugName", useful: str = "usefulCount",
                        scorer=None, text_col: str = "review", materialize: bool = True,
                        fit_on: DataFrame | None = None) -> DataFrame:
    """Codes, z-scores, quality/frequency flags, sentiment and its dummies.

    Statistics and dictionaries come from ``fit_on`` (``df`` itself if not given): a
    category that it doesn't hold gets code -1 and no flag.

    With ``materialize`` the input is first written to the checkpoint folder
    (the stage hand-off the reference does with CSV files), so the fitting
    passes below re-read a stored table instead of recomputing the cleaning.
    Fitting takes one grouped pass per categorical column and one aggregate for
    the global moments.
    """
    from reviewlab.operators.sentiment import score_sentiment
    from reviewlab.session import cut_lineage

    if materialize:
        df = cut_lineage(df)
    cats = [c for c in categorical if c in df.columns]
    zcols = [c for c in ("word_count", "upper_count") if c in df.columns]
    mom = [useful, *zcols]
    fitted = df if fit_on is None else fit_on
    per_key = cut_lineage(fitted.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.avg(useful).alias("_avg")))  # one row per key
    # Spark's own mergeable moments: sums of squares would lose a small spread on a large mean
    fits = fit_moments(fitted, mom)
    tot = per_key.where(F.col(key).isNotNull()).agg(
        (F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).alias("avg_n")).first()
    flags = per_key.where(F.col(key).isNotNull()).select(
        key, F.col("_avg"), (F.col("_n") > F.lit(tot["avg_n"])).cast("int").alias("reviewFrequency"))
    d = df.join(few(flags), key, "left").withColumns({
        "reviewQuality": F.coalesce(F.col(useful) > F.col("_avg"), F.lit(False)).cast("int"),
        "reviewFrequency": F.coalesce(F.col("reviewFrequency"), F.lit(0)),
        "usefulStandardized": _z(useful, *fits[useful], zero_sd_as_one=False),
        **{c: _z(c, *fits[c], zero_sd_as_one=False) for c in zcols}}).drop("_avg")
    for c in cats:
        src = per_key.select(key) if c == key else fitted
        d = apply_label_codes(d, c, fit_label_codes(src, c))
    if text_col in d.columns:
        d = score_sentiment(d, text_col, out="sentiment", scorer=scorer)
        d = d.withColumns({"dummy_sentiment_1": (F.col("sentiment") == 1).cast("int"),
                           "dummy_sentiment_2": (F.col("sentiment") == 2).cast("int")})
    return d
