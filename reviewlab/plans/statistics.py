"""Slice 4: statistics and OLS from one Gram aggregate, on ``lineitem`` measures."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from reviewlab.operators import regress as rg
from reviewlab.operators import stats as st
from reviewlab.operators.indexing import ordered_index
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.sources.fixtures import REVIEWS_EVT_SQL, VECTORS_EMB_SQL, reviews_evt, split_bucket, split_bucket_sql, vectors_emb
from reviewlab.sources.io import read_table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI = "WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)\n"


def _li(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *MEASURES)


def _pairs_sql(fn: str, name: str, digits: int = 6) -> str:
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, {r_sql(f'{fn}({a}, {b})', digits)} AS {name} FROM li"
             for a in MEASURES for b in MEASURES]
    return LI + "\nUNION ALL ".join(parts)


@register("li_correlation", _pairs_sql("corr", "corr"))
def li_correlation(spark, sf):
    """STA-1."""
    return st.correlation(_li(spark, sf), MEASURES).select("a", "b", rnd("corr").alias("corr"))


@register("li_covariance", _pairs_sql("covar_samp", "cov", 4))
def li_covariance(spark, sf):
    """STA-2."""
    return st.covariance(_li(spark, sf), MEASURES).select("a", "b", rnd("cov", 4).alias("cov"))


X3 = ["l_quantity", "l_discount", "l_tax"]
_G = {(i, j): f"sum({X3[i]} * {X3[j]})" for i in range(3) for j in range(3)}


def _vif_sql() -> str:
    g = lambda i, j: f"g{min(i, j)}{max(i, j)}"
    sel = ", ".join(f"{_G[(i, j)]} AS g{i}{j}" for i in range(3) for j in range(i, 3))
    det = (f"({g(0,0)} * ({g(1,1)} * {g(2,2)} - {g(1,2)} * {g(1,2)}) - {g(0,1)} * ({g(0,1)} * {g(2,2)} - {g(1,2)} * {g(0,2)})"
           f" + {g(0,2)} * ({g(0,1)} * {g(1,2)} - {g(1,1)} * {g(0,2)}))")
    cof = [f"({g(1,1)} * {g(2,2)} - {g(1,2)} * {g(1,2)})", f"({g(0,0)} * {g(2,2)} - {g(0,2)} * {g(0,2)})",
           f"({g(0,0)} * {g(1,1)} - {g(0,1)} * {g(0,1)})"]
    parts = [f"SELECT '{X3[i]}' AS feature, {r_sql(f'{g(i, i)} * {cof[i]} / {det}')} AS vif FROM m" for i in range(3)]
    return LI + f", m AS (SELECT {sel} FROM li)\n" + "\nUNION ALL ".join(parts)


@register("li_vif", _vif_sql())
def li_vif(spark, sf):
    """STA-3: uncentred VIF."""
    return rg.vif(_li(spark, sf), X3).select("feature", rnd("vif").alias("vif"))


@register("li_ols_fit", LI + f"""
SELECT 'const' AS feature, {r_sql('regr_intercept(l_tax, l_discount)')} AS coef FROM li
UNION ALL SELECT 'l_discount', {r_sql('regr_slope(l_tax, l_discount)')} FROM li""")
def li_ols_fit(spark, sf):
    """REG-1: linear regression with an intercept."""
    res = rg.fit(_li(spark, sf), ["l_discount"], "l_tax", intercept=True)
    return rg.coef_table(spark, res).select("feature", rnd("coef").alias("coef"))


@register("li_ols_t", LI + f"""
, m AS (SELECT sum(l_discount * l_discount) a, sum(l_discount * l_quantity) b, sum(l_quantity * l_quantity) d,
               sum(l_discount * l_tax) u, sum(l_quantity * l_tax) v, sum(l_tax * l_tax) yy, count(*) n FROM li)
, s AS (SELECT *, a * d - b * b AS det FROM m)
, e AS (SELECT *, (d * u - b * v) / det AS b1, (a * v - b * u) / det AS b2 FROM s)
, f AS (SELECT *, (yy - b1 * u - b2 * v) / (n - 2) AS s2 FROM e)
SELECT 'l_discount' AS feature, {r_sql('b1')} AS coef, {r_sql('sqrt(s2 * d / det)')} AS std_err,
       {r_sql('b1 / sqrt(s2 * d / det)', 4)} AS t FROM f
UNION ALL SELECT 'l_quantity', {r_sql('b2')}, {r_sql('sqrt(s2 * a / det)')}, {r_sql('b2 / sqrt(s2 * a / det)', 4)} FROM f""")
def li_ols_t(spark, sf):
    """REG-3: OLS without a constant, t statistic per regressor."""
    res = rg.fit(_li(spark, sf), ["l_discount", "l_quantity"], "l_tax", intercept=False)
    return rg.coef_table(spark, res).select("feature", rnd("coef").alias("coef"), rnd("std_err").alias("std_err"),
                                            rnd("t", 4).alias("t"))


@register("li_ols_incomplete", LI + f"""
, g AS (SELECT CASE WHEN l_partkey % 5 <> 0 THEN l_discount END AS x, CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS z,
               CASE WHEN l_partkey % 11 <> 0 THEN l_tax END AS y FROM li)
, c AS (SELECT * FROM g WHERE x IS NOT NULL AND z IS NOT NULL AND y IS NOT NULL)
, m AS (SELECT count(*) n, avg(y) my, avg(x) mx, avg(z) mz, covar_pop(x, x) a, covar_pop(x, z) b, covar_pop(z, z) d,
               covar_pop(x, y) u, covar_pop(z, y) v FROM c)
, e AS (SELECT *, (d * u - b * v) / (a * d - b * b) AS b1, (a * v - b * u) / (a * d - b * b) AS b2 FROM m)
SELECT CAST(n AS BIGINT) AS n, CAST((SELECT count(*) FROM g) - n AS BIGINT) AS dropped, {r_sql('my - b1 * mx - b2 * mz')} AS const,
       {r_sql('b1')} AS x, {r_sql('b2')} AS z FROM e""")
def li_ols_incomplete(spark, sf):
    """REG-1 on rows of which some lack a regressor or the target: the fit is that of the complete rows."""
    some = lambda c, k: F.when(F.col("l_partkey") % k != 0, F.col(c))
    g = _li(spark, sf).select(some("l_discount", 5).alias("x"), some("l_quantity", 7).alias("z"), some("l_tax", 11).alias("y"))
    res = rg.fit(g, ["x", "z"], "y", intercept=True)
    out = spark.createDataFrame([(res.n, res.dropped, *map(float, res.beta))], "n long, dropped long, const double, x double, z double")
    return out.select("n", "dropped", *[rnd(c).alias(c) for c in ("const", "x", "z")])


@register("li_f_statistic", LI + f"""
, m AS (SELECT sum(l_quantity * l_quantity) a, sum(l_quantity * l_discount) b, sum(l_discount * l_discount) d,
               sum(l_quantity * l_tax) u, sum(l_discount * l_tax) v, sum(l_tax * l_tax) yy, count(*) n FROM li)
, e AS (SELECT *, (u * (d * u - b * v) + v * (a * v - b * u)) / (a * d - b * b) AS model FROM m)
SELECT {r_sql('(model / 2) / ((yy - model) / (n - 2))', 3)} AS f FROM e""")
def li_f_statistic(spark, sf):
    """REG-4: the F statistic of a fit without a constant (``li_f_test`` has its p value)."""
    res = rg.fit(_li(spark, sf), X3[:2], "l_tax", intercept=False)
    return rg.goodness_table(spark, res).select(rnd("f", 3).alias("f"))


@register("li_ols_goodness", LI + f"""
, m AS (SELECT count(*) n, regr_r2(l_tax, l_discount) r2, regr_syy(l_tax, l_discount) tss FROM li)
, s AS (SELECT *, tss * (1 - r2) AS ssr FROM m)
, l AS (SELECT *, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS llf FROM s)
SELECT CAST(n AS BIGINT) AS n, 1 AS k, {r_sql('r2')} AS r2, {r_sql('1 - (n - 1) / (n - 2.0) * (1 - r2)')} AS r2_adj,
       {r_sql('tss - ssr')} AS mse_model, {r_sql('-2 * llf + 4', 3)} AS aic, {r_sql('-2 * llf + ln(n) * 2', 3)} AS bic,
       {r_sql('(tss - ssr) / (ssr / (n - 2))', 4)} AS f FROM l""")
def li_ols_goodness(spark, sf):
    """REG-7 and REG-4's F statistic for a one-regressor fit with a constant."""
    res = rg.fit(_li(spark, sf), ["l_discount"], "l_tax", intercept=True)
    g = rg.goodness_table(spark, res)
    return g.select("n", "k", rnd("r2").alias("r2"), rnd("r2_adj").alias("r2_adj"), rnd("mse_model").alias("mse_model"),
                    rnd("aic", 3).alias("aic"), rnd("bic", 3).alias("bic"), rnd("f", 4).alias("f"))


@register("li_f_test")
def li_f_test(spark, sf):
    """REG-4: F statistic and p value (p from the F distribution: rows-only)."""
    res = rg.fit(_li(spark, sf), X3[:2], "l_tax", intercept=False)
    return rg.goodness_table(spark, res).select("f", "f_p")


@register("li_t_pvalues")
def li_t_pvalues(spark, sf):
    """REG-3 with p values and the significance flag (rows-only)."""
    res = rg.fit(_li(spark, sf), X3[:2], "l_tax", intercept=False)
    return rg.coef_table(spark, res)


TRAIN = f"{split_bucket_sql('l_orderkey * 10 + l_linenumber')} <> 0"
TEST = f"{split_bucket_sql('l_orderkey * 10 + l_linenumber')} = 0"


def _split(spark, sf):
    d = _li(spark, sf).withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    b = split_bucket("rid")
    return d.where(b != 0), d.where(b == 0)


@register("li_mean_interval", LI + f"""
, tr AS (SELECT * FROM li WHERE {TRAIN}), te AS (SELECT * FROM li WHERE {TEST})
, m AS (SELECT sum(l_quantity * l_quantity) g, sum(l_quantity * l_tax) u, sum(l_tax * l_tax) yy, count(*) n FROM tr)
, f AS (SELECT *, u / g AS beta, (yy - u * u / g) / (n - 1) AS s2 FROM m)
SELECT te.l_orderkey, te.l_linenumber, te.l_partkey, {r_sql('te.l_quantity * beta')} AS prediction,
       {r_sql('sqrt(s2 * te.l_quantity * te.l_quantity / g)')} AS se_mean FROM te, f""")
def li_mean_interval(spark, sf):
    """REG-5: mean prediction and its standard error for test rows (fit on train)."""
    train, test = _split(spark, sf)
    res = rg.fit(train, ["l_quantity"], "l_tax", intercept=False)
    out = rg.mean_interval(test, res, alpha=0.01)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", rnd("prediction").alias("prediction"),
                      rnd("se_mean").alias("se_mean"))


@register("li_mean_interval_bounds")
def li_mean_interval_bounds(spark, sf):
    """REG-5 with the 99 % bounds (t quantile from the JVM: rows-only)."""
    train, test = _split(spark, sf)
    res = rg.fit(train, ["l_quantity", "l_discount"], "l_tax", intercept=False)
    return rg.mean_interval(test, res, alpha=0.01).select("l_orderkey", "l_linenumber", "prediction",
                                                          "mean_ci_lower", "mean_ci_upper")


@register("li_series_order", LI + f"""
, tr AS (SELECT * FROM li WHERE {TRAIN}), te AS (SELECT * FROM li WHERE {TEST})
, m AS (SELECT regr_slope(l_tax, l_quantity) b, regr_intercept(l_tax, l_quantity) a, count(*) n FROM tr)
SELECT 'train' AS series, CAST(row_number() OVER (ORDER BY l_tax, l_orderkey, l_linenumber, l_partkey) - 1 AS BIGINT) AS idx,
       {r_sql('l_tax')} AS value, {r_sql('l_tax')} AS actual FROM tr
UNION ALL
SELECT 'test', CAST(row_number() OVER (ORDER BY l_tax, l_orderkey, l_linenumber, l_partkey) - 1 + (SELECT n FROM m) AS BIGINT),
       {r_sql('a + b * l_quantity')}, {r_sql('l_tax')} FROM te, m""")
def li_series_order(spark, sf):
    """REG-1 predictions laid out as REG-2's train / test series in target order."""
    train, test = _split(spark, sf)
    res = rg.fit(train, ["l_quantity"], "l_tax", intercept=True)
    keys = ["l_tax", "l_orderkey", "l_linenumber", "l_partkey"]
    n_train = train.count()
    tr = ordered_index(train.select(*keys), keys, out="idx").select(
        F.lit("train").alias("series"), "idx", rnd("l_tax").alias("value"), rnd("l_tax").alias("actual"))
    te = ordered_index(test.select(*keys, "l_quantity"), keys, out="idx", start=n_train).select(
        F.lit("test").alias("series"), "idx", rnd(rg.predict(res)).alias("value"), rnd("l_tax").alias("actual"))
    return tr.unionByName(te)


@register("evt_ols_epoch", f"""
SELECT {r_sql('regr_slope(value, epoch(ts)) * 86400')} AS slope_per_day, {r_sql('regr_r2(value, epoch(ts))')} AS r2,
       {r_sql('avg(value)')} AS at_mean FROM events""")
def evt_ols_epoch(spark, sf):
    """REG-1 with a large uncentred regressor: event value against time in seconds."""
    e = spark.read.parquet(f"{sf}/events.parquet").select(
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("x"), F.col("value").alias("y"))
    fit = rg.fit(e, ["x"], "y")
    at = fit.beta[0] + fit.beta[1] * fit.mean[0]
    row = spark.createDataFrame([(float(fit.beta[1] * 86400), float(fit.r2), float(at))], "slope_per_day double, r2 double, at_mean double")
    return row.select(*(rnd(c).alias(c) for c in row.columns))


@register("li_stepwise")
def li_stepwise(spark, sf):
    """REG-6: backward stepwise elimination table (rows-only; checked against numpy in tests)."""
    table, _ = rg.stepwise(_li(spark, sf), ["l_quantity", "l_discount", "l_extendedprice"], "l_tax")
    return table


@register("li_condition_number")
def li_condition_number(spark, sf):
    """STA-4: covariance condition number."""
    c = st.covariance_condition_number(_li(spark, sf), X3)
    return spark.createDataFrame([(float(c),)], "condition_number double")


@register("evt_top_useful_per_condition", f"""WITH r AS ({REVIEWS_EVT_SQL})
SELECT condition, id, {r_sql('usefulCount')} AS usefulCount FROM (
  SELECT *, row_number() OVER (PARTITION BY condition ORDER BY usefulCount DESC, id) rn FROM r) WHERE rn = 1""")
def evt_top_useful_per_condition(spark, sf):
    """AGG-9: arg-max per group with an id tie-break."""
    r = reviews_evt(spark, sf)
    return st.arg_extreme(r, "condition", "usefulCount", "id").select("condition", "id", rnd("usefulCount").alias("usefulCount"))


@register("emb_vector_mean", f"""WITH e AS ({VECTORS_EMB_SQL})
SELECT label, CAST(i - 1 AS INTEGER) AS dim, {r_sql('avg(v[i])')} AS mean
FROM (SELECT label, v, unnest(generate_series(1, len(v))) AS i FROM e) GROUP BY label, i""")
def emb_vector_mean(spark, sf):
    """AGG-11: element-wise mean vector per label."""
    return st.vector_mean(vectors_emb(spark, sf), "v", "label").select("label", "dim", rnd("mean").alias("mean"))
