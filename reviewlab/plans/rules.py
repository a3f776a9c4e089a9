"""Slice 7: baskets, frequent itemsets, association rules, category dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.operators import rules as ru
from reviewlab.operators.clean import clean_data, decode
from reviewlab.operators.features import apply_label_codes, fit_label_codes
from reviewlab.plans.cleaning import NULL_NONE, TEXT_CTE, imputation_ctes
from reviewlab.plans.registry import r_sql, register, rnd
from reviewlab.plans.sqltext import marker_null_sql
from reviewlab.sources.fixtures import REVIEWS_DOC_SQL, reviews_doc

MIN_SUPPORT, MIN_CONF = 0.005, 0.8
BASKET_CTE = TEXT_CTE + f""",
cl AS (SELECT * FROM d3 WHERE {NULL_NONE}),
b AS (SELECT id, list_sort(list_distinct(list_filter(['drug=' || drugName, 'condition=' || condition,
        CASE WHEN (CASE WHEN rating < 6 THEN 0 WHEN rating > 5 THEN 1 ELSE 0 END) = 1 THEN 'rating' END],
        lambda x: x IS NOT NULL))) AS items FROM cl),
n AS (SELECT count(*) AS n FROM b),
subs AS (SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS s
         FROM (SELECT items, unnest(generate_series(1, (1 << len(items)) - 1)) AS mask FROM b)),
its AS (SELECT s AS items, count(*) AS freq FROM subs GROUP BY s HAVING count(*) >= ceil({MIN_SUPPORT} * (SELECT n FROM n)))
"""


def _baskets(spark, sf):
    return ru.baskets(clean_data(reviews_doc(spark, sf)))


@register("doc_baskets", BASKET_CTE + "SELECT id, array_to_string(items, ',') AS items FROM b")
def doc_baskets(spark, sf):
    """ASC-1, ENC-3: one basket per cleaned review."""
    return _baskets(spark, sf).select("id", F.array_join("items", ",").alias("items"))


@register("doc_itemsets", BASKET_CTE + f"""
SELECT array_to_string(items, ',') AS items, freq, {r_sql('freq / n')} AS support FROM its, n""")
def doc_itemsets(spark, sf):
    """ASC-2: frequent itemsets, minimum support 0.005."""
    its = ru.frequent_itemsets(_baskets(spark, sf), MIN_SUPPORT)
    return its.select(F.array_join("items", ",").alias("items"), "freq", rnd("support").alias("support"))


@register("doc_rules", BASKET_CTE + f""",
multi AS (SELECT items, freq FROM its WHERE len(items) >= 2),
sp AS (SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS a,
              list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0) AS c, freq
       FROM (SELECT items, freq, unnest(generate_series(1, (1 << len(items)) - 2)) AS mask FROM multi)),
j AS (SELECT sp.a, sp.c, sp.freq / n.n AS sAC, ia.freq / n.n AS sA, ic.freq / n.n AS sC
      FROM sp JOIN its ia ON ia.items = sp.a JOIN its ic ON ic.items = sp.c, n),
r AS (SELECT *, sAC / sA AS confidence FROM j WHERE sAC / sA >= {MIN_CONF})
SELECT array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents,
  {r_sql('sA')} AS antecedent_support, {r_sql('sC')} AS consequent_support, {r_sql('sAC')} AS support,
  {r_sql('confidence')} AS confidence, {r_sql('confidence / sC')} AS lift, 1.0 AS representativity,
  {r_sql('sAC - sA * sC')} AS leverage,
  CASE WHEN confidence >= 1 THEN 'inf'::DOUBLE ELSE {r_sql('(1 - sC) / (1 - confidence)')} END AS conviction,
  CASE WHEN greatest(sAC * (1 - sA), sA * (sC - sAC)) = 0 THEN 'nan'::DOUBLE
       ELSE {r_sql('(sAC - sA * sC) / greatest(sAC * (1 - sA), sA * (sC - sAC))')} END AS zhangs_metric,
  {r_sql('sAC / (sA + sC - sAC)')} AS jaccard,
  CASE WHEN sC >= 1 THEN 0.0 ELSE {r_sql('(confidence - sC) / (1 - sC)')} END AS certainty,
  {r_sql('0.5 * (sAC / sA + sAC / sC)')} AS kulczynski
FROM r ORDER BY confidence DESC, lift DESC, antecedents, consequents""")
def doc_rules(spark, sf):
    """ASC-3, ASC-4, SRT-2: all rules with confidence >= 0.8 and their measures."""
    its = ru.frequent_itemsets(_baskets(spark, sf), MIN_SUPPORT)
    r = ru.association_rules(its, MIN_CONF)
    keep = {"antecedents", "consequents", "representativity"}
    return r.select(*[F.col(c) if c in keep else rnd(c).alias(c) for c in r.columns])


RAW_COLS = ["id", "drugName", "condition", "review", "rating", "usefulCount"]
_D, _T = imputation_ctes("c", RAW_COLS)
DIMS_CTE = f"""WITH raw AS ({REVIEWS_DOC_SQL}),
c AS (SELECT id, drugName, {marker_null_sql('condition')} AS condition, review, rating, usefulCount FROM raw)
{_D}{_T},
kept AS (SELECT * FROM d3 WHERE {' AND '.join(f'{x} IS NOT NULL' for x in RAW_COLS)})
"""


@register("doc_category_dims", DIMS_CTE + """
SELECT 'drug' AS kind, CAST(dense_rank() OVER (ORDER BY drugName) - 1 AS INTEGER) AS code, drugName AS name
FROM (SELECT DISTINCT drugName FROM kept)
UNION ALL
SELECT 'condition', CAST(dense_rank() OVER (ORDER BY condition) - 1 AS INTEGER), condition
FROM (SELECT DISTINCT condition FROM kept)""")
def doc_category_dims(spark, sf):
    """ASC-5: (code, name) dimensions built from the raw rows."""
    drugs, conds = ru.category_dims(reviews_doc(spark, sf))
    return (drugs.select(F.lit("drug").alias("kind"), F.col("drugName").alias("code"), F.col("d_name").alias("name"))
            .unionByName(conds.select(F.lit("condition").alias("kind"), F.col("condition").alias("code"),
                                      F.col("c_name").alias("name"))))


@register("doc_decoded", DIMS_CTE + "SELECT id, drugName, condition FROM kept")
def doc_decoded(spark, sf):
    """ENC-1 then JN-4: codes back to names through the dimensions."""
    from reviewlab.operators.clean import raw_impute
    kept = raw_impute(reviews_doc(spark, sf))
    dcodes, ccodes = fit_label_codes(kept, "drugName"), fit_label_codes(kept, "condition")
    coded = apply_label_codes(apply_label_codes(kept, "drugName", dcodes), "condition", ccodes)
    out = decode(coded, "drugName", dcodes, "_code", "drugName")
    out = decode(out, "condition", ccodes, "_code", "condition")
    return out.select("id", "drugName", "condition")
