"""Slice 1: reviews stand-in built from ``events`` -> codes, scaling, per-drug flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.functions.encode import bool_to_int, rating_band3, rating_binary
from reviewlab.operators import features as fe
from reviewlab.operators import sampling as sm
from reviewlab.operators.clean import keep_first
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.sources.fixtures import REVIEWS_EVT_SQL, reviews_evt, split_bucket_sql

EVT = f"WITH r AS ({REVIEWS_EVT_SQL})\n"


def evt_features_df(spark, sf):
    """ENC-1, WIN-1..4, MTH-1 through the one-grouped-pass feature builder."""
    # the input is a plain Parquet scan: re-reading it is as cheap as a checkpoint
    return fe.feature_engineering(reviews_evt(spark, sf), categorical=("drugName", "condition", "date"),
                                  materialize=False)


@register("evt_features", EVT + f"""
, s AS (SELECT avg(usefulCount) m, stddev_samp(usefulCount) sd FROM r)
, g AS (SELECT drugName, avg(usefulCount) a, count(*) n FROM r GROUP BY drugName)
, t AS (SELECT sum(n * n) / sum(n) avg_n FROM g)
SELECT r.id,
  CAST(dense_rank() OVER (ORDER BY r.drugName) - 1 AS INTEGER) AS drugName,
  CAST(dense_rank() OVER (ORDER BY r.condition) - 1 AS INTEGER) AS condition,
  CAST(dense_rank() OVER (ORDER BY r.date) - 1 AS INTEGER) AS date,
  r.rating,
  {r_sql('r.usefulCount')} AS usefulCount,
  CAST(r.usefulCount > g.a AS INTEGER) AS reviewQuality,
  {r_sql('(r.usefulCount - s.m) / s.sd')} AS usefulStandardized,
  CAST(g.n > t.avg_n AS INTEGER) AS reviewFrequency
FROM r JOIN g ON r.drugName = g.drugName, s, t""")
def evt_features(spark, sf):
    """ENC-1, PRJ-2, MTH-1, WIN-1..4 on every row."""
    d = evt_features_df(spark, sf)
    return d.select("id", "drugName", "condition", "date", "rating", rnd("usefulCount").alias("usefulCount"),
                    "reviewQuality", rnd("usefulStandardized").alias("usefulStandardized"), "reviewFrequency")


@register("evt_drug_summary", EVT + f"""
, s AS (SELECT avg(usefulCount) m, stddev_samp(usefulCount) sd FROM r)
, g AS (SELECT drugName, avg(usefulCount) a, count(*) n FROM r GROUP BY drugName)
, t AS (SELECT sum(n * n) / sum(n) avg_n FROM g)
, f AS (SELECT CAST(dense_rank() OVER (ORDER BY r.drugName) - 1 AS INTEGER) AS drug_code,
          CAST(r.usefulCount > g.a AS INTEGER) AS q, (r.usefulCount - s.m) / s.sd AS z,
          CAST(g.n > t.avg_n AS INTEGER) AS freq
        FROM r JOIN g ON r.drugName = g.drugName, s, t)
SELECT drug_code, count(*) AS n_reviews, {r_sql('avg(q)')} AS quality_share,
       {r_sql('avg(z)')} AS mean_useful_z, max(freq) AS reviewFrequency
FROM f GROUP BY drug_code""")
def evt_drug_summary(spark, sf):
    """Flagship: reviews per drug with quality and frequency flags, standardised usefulness."""
    d = evt_features_df(spark, sf)
    return (d.groupBy(F.col("drugName").alias("drug_code"))
            .agg(F.count(F.lit(1)).alias("n_reviews"), rnd(F.avg("reviewQuality")).alias("quality_share"),
                 rnd(F.avg("usefulStandardized")).alias("mean_useful_z"),
                 F.max("reviewFrequency").alias("reviewFrequency")))


@register("evt_label_codes", EVT + """
SELECT date AS value, CAST(dense_rank() OVER (ORDER BY date) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT date FROM r WHERE date IS NOT NULL)""")
def evt_label_codes(spark, sf):
    """ENC-1 dictionary for the date strings (lexicographic order)."""
    return fe.fit_label_codes(reviews_evt(spark, sf), "date").select(
        F.col("date").alias("value"), F.col("_code").alias("code"))


@register("evt_scaling", EVT + f"""
, s AS (SELECT min(usefulCount) lo, max(usefulCount) hi, avg(usefulCount) m, stddev_pop(usefulCount) sp,
               avg(rating) mr, stddev_pop(rating) spr FROM r)
SELECT id, {r_sql('(usefulCount - lo) / (hi - lo)')} AS useful_minmax,
       {r_sql('(usefulCount - m) / sp')} AS useful_scaled,
       {r_sql('(rating - mr) / spr')} AS rating_scaled
FROM r, s""")
def evt_scaling(spark, sf):
    """MTH-2 (min-max) and MTH-3 (ddof 0) scaling."""
    r = reviews_evt(spark, sf)
    a = fe.min_max_scale(r.select("id", F.col("usefulCount").alias("useful_minmax")), ["useful_minmax"])
    b = fe.standardize(r.select("id", F.col("usefulCount").alias("useful_scaled"),
                                F.col("rating").alias("rating_scaled")), ["useful_scaled", "rating_scaled"], ddof=0)
    return a.join(b, "id").select("id", rnd("useful_minmax").alias("useful_minmax"),
                                  rnd("useful_scaled").alias("useful_scaled"),
                                  rnd("rating_scaled").alias("rating_scaled"))


@register("evt_rating_bands", EVT + """
SELECT id, rating,
  CAST(CASE WHEN rating < 4 THEN 0 WHEN rating >= 4 AND rating <= 7 THEN 1 WHEN rating > 7 THEN 2 ELSE 0 END AS INTEGER) AS band3,
  CAST(CASE WHEN rating < 6 THEN 0 WHEN rating > 5 THEN 1 ELSE 0 END AS INTEGER) AS band2,
  CAST(usefulCount > 100 AS INTEGER) AS high_useful
FROM r""")
def evt_rating_bands(spark, sf):
    """FLT-7, FLT-8, PRJ-4."""
    r = reviews_evt(spark, sf)
    return r.select("id", "rating", rating_band3("rating").alias("band3"), rating_binary("rating").alias("band2"),
                    bool_to_int(F.col("usefulCount") > 100).alias("high_useful"))


@register("evt_value_counts", EVT + """
SELECT rating, count(*) AS n FROM r GROUP BY rating ORDER BY n DESC, rating""")
def evt_value_counts(spark, sf):
    """AGG-3, SRT-3: value counts sorted by size."""
    r = reviews_evt(spark, sf)
    return r.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rating")


@register("evt_moments", EVT + f"""
SELECT count(*) AS n_rows, 6 AS n_cols, {r_sql('avg(usefulCount)')} AS mean_useful,
       {r_sql('stddev_samp(usefulCount)')} AS std_useful, {r_sql('avg(rating)')} AS mean_rating
FROM r""")
def evt_moments(spark, sf):
    """AGG-1, AGG-2, AGG-4."""
    r = reviews_evt(spark, sf)
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(r.columns)).alias("n_cols"),
                 rnd(F.avg("usefulCount")).alias("mean_useful"),
                 rnd(F.stddev_samp("usefulCount")).alias("std_useful"),
                 rnd(F.avg("rating")).alias("mean_rating"))


@register("evt_drugs_per_condition", EVT + """
SELECT condition, count(DISTINCT drugName) AS n_drugs FROM r GROUP BY condition ORDER BY n_drugs DESC, condition""")
def evt_drugs_per_condition(spark, sf):
    """AGG-8."""
    r = reviews_evt(spark, sf)
    return (r.groupBy("condition").agg(F.count_distinct("drugName").alias("n_drugs"))
            .orderBy(F.desc("n_drugs"), "condition"))


@register("evt_first_per_drug", EVT + """
SELECT id, drugName, condition, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY drugName ORDER BY id) AS rn FROM r) WHERE rn = 1""")
def evt_first_per_drug(spark, sf):
    """AGG-5: keep-first dedup on drugName."""
    r = reviews_evt(spark, sf).select("id", "drugName", "condition", "rating")
    return keep_first(r, ["drugName"])


@register("evt_distinct_rows", EVT + """
SELECT DISTINCT drugName, condition, rating FROM r""")
def evt_distinct_rows(spark, sf):
    """AGG-7, PRJ-3."""
    return reviews_evt(spark, sf).select("drugName", "condition", "rating").distinct()


@register("evt_head", EVT + """
SELECT id, drugName, rating FROM r ORDER BY id LIMIT 5""")
def evt_head(spark, sf):
    """LIM-1 (the head report is the feature)."""
    return sm.head(reviews_evt(spark, sf).select("id", "drugName", "rating"), 5)


@register("evt_split_union", EVT + f"""
SELECT id, rating, CASE WHEN {split_bucket_sql('id')} = 0 THEN 0 ELSE 1 END AS src FROM r""")
def evt_split_union(spark, sf):
    """SMP-1 split then SET-1 union (test rows first)."""
    r = reviews_evt(spark, sf).select("id", "rating")
    train, test = sm.train_test_split(r)
    return sm.union_in_order(test, train).select("id", "rating", "src")


@register("evt_holdout_tail", EVT + """
SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 >= CAST(floor((SELECT count(*) FROM r) * 0.8) AS BIGINT) AS INTEGER)
       AS is_validation FROM r""")
def evt_holdout_tail(spark, sf):
    """SMP-2: last 20 % of rows in id order."""
    return sm.holdout_tail(reviews_evt(spark, sf).select("id"), 0.2)


@register("evt_folds", EVT + """
SELECT id, CAST(ntile(5) OVER (PARTITION BY rating ORDER BY id) - 1 AS INTEGER) AS fold FROM r""")
def evt_folds(spark, sf):
    """SMP-3: stratified 5-fold assignment by rating."""
    return sm.stratified_folds(reviews_evt(spark, sf).select("id", "rating"), "rating", 5).select("id", "fold")


@register("evt_sorted_by_useful", EVT + f"""
, s AS (SELECT avg(usefulCount) m, stddev_samp(usefulCount) sd FROM r)
SELECT id, {r_sql('(usefulCount - m) / sd')} AS usefulStandardized FROM r, s ORDER BY usefulStandardized, id""")
def evt_sorted_by_useful(spark, sf):
    """SRT-1: ascending sort with an id tie-break."""
    d = fe.standardize(reviews_evt(spark, sf).select("id", "usefulCount"), ["usefulCount"],
                       out={"usefulCount": "usefulStandardized"})
    return d.select("id", rnd("usefulStandardized").alias("usefulStandardized")).orderBy("usefulStandardized", "id")


@register("evt_partition_flags", f"""WITH r AS ({REVIEWS_EVT_SQL}),
p AS (SELECT id, usefulCount, avg(usefulCount) OVER (PARTITION BY drugName) AS mean, count(*) OVER (PARTITION BY drugName) AS n FROM r)
SELECT id, {r_sql('mean')} AS mean, n, CAST(usefulCount > mean AS INTEGER) AS quality, CAST(n > avg(n) OVER () AS INTEGER) AS frequency FROM p""")
def evt_partition_flags(spark, sf):
    """WIN-1..4 one by one: mean and size of the row's group, above-mean usefulness, above-average frequency."""
    r = reviews_evt(spark, sf)
    out = fe.partition_count(fe.partition_mean(r, "drugName", "usefulCount", "mean"), "drugName", "n")
    out = fe.review_frequency(fe.review_quality(out, out="quality"), out="frequency")
    return out.select("id", rnd("mean").alias("mean"), "n", "quality", "frequency")
