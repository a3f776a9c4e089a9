"""Ordinary least squares from sufficient statistics (REG-1..7, STA-3).

Two Spark aggregates return the means and scales of the columns and then the
cross-products of the centred, scaled columns (a (k+1)^2 block of numbers); every
fit, test, interval and stepwise step after that is d x d algebra on the driver, so
stepwise elimination makes no further passes over the data.  Centring and scaling
first keeps the digits of years, timestamps and other large values.
Formulas follow the usual OLS definitions (statsmodels conventions for AIC,
BIC, adjusted R^2 and mse_model).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.operators.distributions import f_sf, t_ppf, t_sf2


@dataclass
class Moments:
    """Sums over the columns z = (x - mean) / scale; the mean is 0 in a model without a constant."""

    names: list[str]          # regressors, constant first when present
    mean: np.ndarray          # of the regressors without the constant
    scale: np.ndarray
    G: np.ndarray             # z'z
    b: np.ndarray             # z'y, y centred if there is a constant
    yy: float
    my: float
    n: int
    intercept: bool
    dropped: int = 0          # rows left out for a null or NaN in a regressor or the target


def moments(df: DataFrame, features, target: str, intercept: bool = True) -> Moments:
    """All pairwise products of the regressors and the target, after one pass for their means and scales.

    Both passes see the complete rows only: one with a null or NaN in any of these columns counts in ``dropped``.
    """
    feats = list(features)
    k = len(feats)
    every = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(feats)], F.col(target).cast("double").alias("y"))
    rows = complete(every, every.columns)
    dropped = every.count() - rows.count()
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("my"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
                     *[(F.stddev_pop(f"x{i}") if intercept else F.max(F.abs(f"x{i}"))).alias(f"s{i}") for i in range(k)]).first()
    my = float(first["my"] or 0.0) if intercept else 0.0
    mean = np.array([float(first[f"m{i}"] or 0.0) if intercept else 0.0 for i in range(k)])
    # a constant column has no spread; it stays as the zero column that it is once centred
    scale = np.array([float(first[f"s{i}"] or 0.0) or 1.0 for i in range(k)])
    z = [(F.col(f"x{i}") - F.lit(float(mean[i]))) / F.lit(float(scale[i])) for i in range(k)] + [F.col("y") - F.lit(my)]
    sums = rows.agg(F.count(F.lit(1)).alias("_"), *[F.sum(z[i] * z[j]).alias(f"g_{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]).first()
    full = np.zeros((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i, k + 1):
            full[i, j] = full[j, i] = sums[f"g_{i}_{j}"] or 0.0
    return Moments(["const"] + feats if intercept else feats, mean, scale, full[:k, :k], full[:k, k], float(full[k, k]), my,
                   int(first["n"]), intercept, dropped)


def complete(df: DataFrame, columns) -> DataFrame:
    """Rows without a null or NaN in ``columns``."""
    for c in columns:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


@dataclass
class OLS:
    names: list[str]
    beta: np.ndarray
    se: np.ndarray
    t: np.ndarray
    p: np.ndarray
    n: int
    k: int
    df_resid: float
    ssr: float
    tss: float
    r2: float
    r2_adj: float
    mse_model: float
    f: float
    f_p: float
    llf: float
    aic: float
    bic: float
    s2: float
    mean: np.ndarray = field(repr=False)     # of the regressors kept, without the constant
    scale: np.ndarray = field(repr=False)
    Ginv: np.ndarray = field(repr=False)     # inverse of their z'z
    intercept: bool = True
    dropped: int = 0


def solve(spark, m: Moments, keep: list[str] | None = None) -> OLS:
    """OLS on a subset of the regressors (sub-matrix of the same moments)."""
    keep = keep if keep is not None else m.names
    c = int(m.intercept)
    if c and "const" not in keep:
        raise ValueError("the moments are centred: take moments(..., intercept=False) for a model without a constant")
    feats = [x for x in m.names if x != "const"]
    idx = [feats.index(x) for x in keep if x != "const"]
    k = len(idx)
    b, mean, scale = m.b[idx], m.mean[idx], m.scale[idx]
    Ginv = np.linalg.pinv(m.G[np.ix_(idx, idx)]) if k else np.zeros((0, 0))
    slope = Ginv @ b
    raw = slope / scale
    ssr = max(float(m.yy - slope @ b), 0.0)
    dfr = m.n - k - c
    tss = float(m.yy)
    s2 = ssr / dfr if dfr > 0 else float("nan")
    se = np.sqrt(np.maximum(np.diag(Ginv) * s2, 0.0)) / scale
    beta = raw
    if c:
        at = mean / scale
        beta = np.concatenate([[m.my - raw @ mean], raw])
        se = np.concatenate([[math.sqrt(max(s2 * (1 / m.n + at @ Ginv @ at), 0.0)) if s2 == s2 else float("nan")], se])
    with np.errstate(divide="ignore", invalid="ignore"):
        t = beta / se
    p = np.array([t_sf2(spark, float(x), dfr) for x in t])
    r2 = 1.0 - ssr / tss if tss else float("nan")
    r2_adj = 1.0 - (m.n - c) / dfr * (1.0 - r2) if dfr > 0 else float("nan")
    mse_model = (tss - ssr) / k if k else float("nan")
    fval = mse_model / s2 if k and s2 else float("nan")
    f_p = f_sf(spark, fval, k, dfr) if k else float("nan")
    llf = -m.n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / m.n) + 1.0) if ssr > 0 else float("inf")
    aic = -2 * llf + 2 * (k + c)
    bic = -2 * llf + math.log(m.n) * (k + c)
    return OLS(list(keep), beta, se, t, p, m.n, k, dfr, ssr, tss, r2, r2_adj, mse_model, fval, f_p, llf,
               aic, bic, s2, mean, scale, Ginv, bool(c), m.dropped)


def fit(df: DataFrame, features, target: str, intercept: bool = True) -> OLS:
    """REG-1: fit (one data pass)."""
    return solve(df.sparkSession, moments(df, features, target, intercept))


def _spark(df_or_spark):
    return df_or_spark if isinstance(df_or_spark, SparkSession) else df_or_spark.sparkSession


def coef_table(spark: SparkSession, res: OLS, alpha: float = 0.05) -> DataFrame:
    """REG-3: per regressor coefficient, standard error, t, p and significance."""
    rows = [(nm, float(b), float(s), float(t), float(p), int(p < alpha))
            for nm, b, s, t, p in zip(res.names, res.beta, res.se, res.t, res.p)]
    return spark.createDataFrame(rows, "feature string, coef double, std_err double, t double, p double, significant int")


def goodness_table(spark: SparkSession, res: OLS) -> DataFrame:
    """REG-7 (and REG-4's F statistic)."""
    return spark.createDataFrame(
        [(res.n, res.k, res.r2, res.r2_adj, res.mse_model, res.aic, res.bic, res.f, res.f_p)],
        "n long, k int, r2 double, r2_adj double, mse_model double, aic double, bic double, f double, f_p double")


def predict(res: OLS, out: str = "prediction") -> Column:
    """x'beta as a Column (literal coefficients)."""
    e = F.lit(0.0)
    for nm, b in zip(res.names, res.beta):
        e = e + (F.lit(float(b)) if nm == "const" else F.col(nm).cast("double") * F.lit(float(b)))
    return e.alias(out)


def mean_interval(df: DataFrame, res: OLS, alpha: float = 0.01) -> DataFrame:
    """REG-5: prediction, its standard error and the (1 - alpha) interval of the mean."""
    C = res.Ginv * res.s2
    feats = [nm for nm in res.names if nm != "const"]
    z = [(F.col(nm).cast("double") - F.lit(float(m))) / F.lit(float(s)) for nm, m, s in zip(feats, res.mean, res.scale)]
    quad = F.lit(float(res.s2 / res.n) if res.intercept else 0.0)
    for i in range(len(z)):
        for j in range(len(z)):
            if C[i, j] != 0.0:
                quad = quad + z[i] * z[j] * F.lit(float(C[i, j]))
    tq = t_ppf(df.sparkSession, 1 - alpha / 2, res.df_resid)
    se = F.sqrt(F.greatest(quad, F.lit(0.0)))
    pred = predict(res, "prediction")
    return (df.withColumn("prediction", pred).withColumn("se_mean", se)
            .withColumn("mean_ci_lower", F.col("prediction") - F.lit(tq) * F.col("se_mean"))
            .withColumn("mean_ci_upper", F.col("prediction") + F.lit(tq) * F.col("se_mean")))


def stepwise(df: DataFrame, features, target: str, alpha: float = 0.05) -> tuple[DataFrame, list[str]]:
    """REG-6: backward elimination with a constant, from one moments pass.

    One row per step (the feature with the largest p value, and whether it was
    removed), then one row per feature kept, carrying the final model's
    numbers - the table the reference prints.
    """
    spark = df.sparkSession
    m = moments(df, features, target, intercept=True)
    keep = list(m.names)
    rows, removed, seen = [], [], []
    while True:
        r = solve(spark, m, keep)
        ps = {nm: p for nm, p in zip(r.names, r.p) if nm != "const"}
        if not ps:
            break
        worst = max(ps, key=lambda nm: (ps[nm], -keep.index(nm)))
        seen.append(worst)
        elim = ps[worst] > alpha
        rows.append((len(rows) + 1, worst, r.aic, r.bic, r.mse_model, r.r2_adj, r.r2, float(ps[worst]), int(elim)))
        if not elim:
            for f in features:
                if f not in seen:
                    rows.append((len(rows) + 1, f, r.aic, r.bic, r.mse_model, r.r2_adj, r.r2, float(ps[f]), 0))
                    seen.append(f)
            break
        removed.append(worst)
        keep.remove(worst)
    schema = ("step int, feature string, aic double, bic double, mse_model double, r2_adj double, "
              "r2 double, p double, eliminated int")
    return spark.createDataFrame(rows, schema), removed


def vif(df: DataFrame, features) -> DataFrame:
    """STA-3: uncentred VIF per feature (no constant added): G_ii * (G^-1)_ii."""
    feats = list(features)
    m = moments(df, feats, feats[0], intercept=False)
    Ginv = np.linalg.pinv(m.G)
    rows = [(f, float(m.G[i, i] * Ginv[i, i])) for i, f in enumerate(feats)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")
