"""Slice 2: text cleaning and imputation on the ``documents``-based review table."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlab.functions.text import tokens
from reviewlab.operators import clean as cl
from reviewlab.operators.indexing import first_appearance_ordinal
from reviewlab.plans.registry import register
from reviewlab.plans.sqltext import (
    clean_review_sql, clean_text_sql, marker_null_sql, tokens_sql, upper_count_sql, word_count_sql,
)
from reviewlab.sources.fixtures import REVIEWS_DOC_SQL, reviews_doc
from reviewlab.sources.io import read_table

COLS = ["id", "drugName", "condition", "review", "rating", "usefulCount", "word_count", "upper_count"]
NULL_ANY = " OR ".join(f"{c} IS NULL" for c in COLS)
NULL_NONE = " AND ".join(f"{c} IS NOT NULL" for c in COLS)

CLEAN_CTE = f"""WITH raw AS ({REVIEWS_DOC_SQL}),
c AS (SELECT id, {clean_text_sql('drugName')} AS drugName,
        {clean_text_sql(marker_null_sql('condition'))} AS condition,
        {clean_review_sql('review')} AS review, rating, usefulCount,
        {word_count_sql('review')} AS word_count, {upper_count_sql('review')} AS upper_count
      FROM raw)
"""


def imputation_ctes(src: str, cols: list[str]) -> tuple[str, str]:
    """SQL twins of JN-2 (``d2``) and JN-3 (``still``, ``conds``, ``m``, ``d3``) over CTE ``src``."""
    nul = " OR ".join(f"{src}.{x} IS NULL" for x in cols)
    rest = ", ".join(f"{src}.{x}" for x in cols if x not in ("id", "drugName", "condition"))
    drug = f""",
lk AS (SELECT drugName, condition FROM (SELECT drugName, condition,
         row_number() OVER (PARTITION BY drugName ORDER BY id) rn FROM {src} WHERE drugName IS NOT NULL) WHERE rn = 1),
d2 AS (SELECT {src}.id, {src}.drugName,
         CASE WHEN ({nul}) THEN lk.condition ELSE {src}.condition END AS condition, {rest}
       FROM {src} LEFT JOIN lk ON {src}.drugName = lk.drugName)
"""
    any2 = " OR ".join(f"{x} IS NULL" for x in cols)
    rest2 = ", ".join(f"d2.{x}" for x in cols if x not in ("id", "drugName", "condition"))
    text = f""",
still AS (SELECT * FROM d2 WHERE {any2}),
conds AS (SELECT condition, min(id) AS first_id FROM d2 WHERE condition IS NOT NULL
          GROUP BY condition HAVING condition NOT IN ('eve', 'me')),
m AS (SELECT id, condition FROM (
        SELECT s.id, k.condition, row_number() OVER (PARTITION BY s.id ORDER BY k.first_id DESC) rn
        FROM still s JOIN conds k
          ON regexp_matches(s.review, '[^a-z]\\Q' || k.condition || '\\E[^a-z|s]')) WHERE rn = 1),
d3 AS (SELECT d2.id, d2.drugName, coalesce(m.condition, d2.condition) AS condition, {rest2}
       FROM d2 LEFT JOIN m ON d2.id = m.id)
"""
    return drug, text


_DRUG, _TEXT = imputation_ctes("c", COLS)
DRUG_CTE = CLEAN_CTE + _DRUG
TEXT_CTE = DRUG_CTE + _TEXT


def _cleaned(spark, sf):
    return cl.clean_columns(reviews_doc(spark, sf))


@register("doc_clean_columns", CLEAN_CTE + "SELECT * FROM c")
def doc_clean_columns(spark, sf):
    """FLT-1, STR-1..9, UDF-1, UDF-2: cleaned text columns plus word counts."""
    return _cleaned(spark, sf)


@register("doc_tokens", CLEAN_CTE + f"""
SELECT id, CAST(len({tokens_sql('review')}) AS INTEGER) AS n_tokens,
       array_to_string({tokens_sql('review')}, ' ') AS joined FROM c""")
def doc_tokens(spark, sf):
    """STR-11: tokenise the cleaned review."""
    d = _cleaned(spark, sf)
    t = tokens(F.col("review"))
    return d.select("id", F.size(t).cast("int").alias("n_tokens"), F.array_join(t, " ").alias("joined"))


@register("doc_null_rows", CLEAN_CTE + f"""
SELECT id, drugName, condition FROM c WHERE {NULL_ANY}""")
def doc_null_rows(spark, sf):
    """FLT-2: rows holding a null."""
    return cl.rows_with_null(_cleaned(spark, sf)).select("id", "drugName", "condition")


@register("doc_drug_lookup", DRUG_CTE + "SELECT drugName, condition FROM lk")
def doc_drug_lookup(spark, sf):
    """JN-2 lookup: condition of the first row seen for each drug."""
    return cl.drug_lookup(_cleaned(spark, sf))


@register("doc_impute_by_drug", DRUG_CTE + "SELECT id, drugName, condition FROM d2")
def doc_impute_by_drug(spark, sf):
    """JN-2 + JN-5: rows with a null take their drug's first condition; keyed write-back."""
    raw = reviews_doc(spark, sf)
    d = _cleaned(spark, sf)
    _, holes2 = cl.impute_conditions(raw)
    return cl.upsert(d, holes2.select(*d.columns)).select("id", "drugName", "condition")


@register("doc_condition_order", DRUG_CTE + """
SELECT condition, CAST(dense_rank() OVER (ORDER BY first_id, condition) - 1 AS BIGINT) AS ordinal FROM (
  SELECT condition, min(id) AS first_id FROM d2 WHERE condition IS NOT NULL GROUP BY condition
  HAVING condition NOT IN ('eve', 'me'))""")
def doc_condition_order(spark, sf):
    """FLT-4, FLT-6, WIN-6: known conditions in first-appearance order."""
    raw = reviews_doc(spark, sf)
    d = _cleaned(spark, sf)
    _, holes2 = cl.impute_conditions(raw)
    d2 = cl.upsert(d, holes2.select(*d.columns))
    known = cl.exclude_values(cl.distinct_values(d2, "condition"), "condition")
    fa = first_appearance_ordinal(d2.join(known, "condition", "left_semi"), "condition")
    return fa.select("condition", "ordinal")


@register("doc_text_match", TEXT_CTE + "SELECT id, condition FROM m")
def doc_text_match(spark, sf):
    """JN-3, STR-10: still-null rows take the last known condition found in their text."""
    raw = reviews_doc(spark, sf)
    d = _cleaned(spark, sf)
    _, holes2 = cl.impute_conditions(raw)
    after = cl.upsert(d, holes2.select(*d.columns))
    still = holes2.where(F.col(cl.FLAG))
    return cl.match_conditions(still.select("id", "review"), cl.condition_order(after))


@register("doc_impute_mode", f"""WITH r AS ({REVIEWS_DOC_SQL}),
m AS (SELECT id, drugName, CASE WHEN condition NOT LIKE '%users found this comment helpful%' THEN condition END AS condition FROM r),
k AS (SELECT drugName, condition, count(*) AS n, min(id) AS f FROM m WHERE condition IS NOT NULL GROUP BY ALL),
b AS (SELECT drugName, condition FROM k QUALIFY row_number() OVER (PARTITION BY drugName ORDER BY n DESC, f) = 1)
SELECT m.id, b.condition FROM m LEFT JOIN b ON m.drugName = b.drugName WHERE m.condition IS NULL""")
def doc_impute_mode(spark, sf):
    """JN-2 with the most common condition of the drug instead of its first."""
    d = cl.null_marker(reviews_doc(spark, sf)).select("id", "drugName", "condition")
    return cl.impute_by_key(d.where("condition IS NULL"), cl.drug_lookup(d, how="mode")).select("id", "condition")


@register("doc_text_match_mixed", f"""WITH d AS (SELECT doc_id AS id, text AS review, regexp_extract(text, '[A-Z][A-Za-z]*[ -][A-Za-z]+') AS head FROM documents),
k AS (SELECT head AS condition, min(id) AS first_id FROM d WHERE id % 3 = 0 AND head <> '' GROUP BY head)
SELECT id, condition FROM (SELECT d.id, k.condition, row_number() OVER (PARTITION BY d.id ORDER BY k.first_id DESC) AS rn
  FROM d JOIN k ON regexp_matches(d.review, '[^a-z]' || regexp_escape(k.condition) || '[^a-z|s]')) WHERE rn = 1""")
def doc_text_match_mixed(spark, sf):
    """JN-3 on conditions that begin with a capital: every text takes the last known one found in it."""
    d = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("review"))
    head = F.regexp_extract("review", "[A-Z][A-Za-z]*[ -][A-Za-z]+", 0)
    known = d.where(F.col("id") % 3 == 0).select("id", head.alias("condition")).where("condition <> ''")
    return cl.match_conditions(d, known.groupBy("condition").agg(F.min("id").alias("first_id")))


@register("doc_clean_data", TEXT_CTE + f"SELECT * FROM d3 WHERE {NULL_NONE}")
def doc_clean_data(spark, sf):
    """PIPE-1: the whole clean_data step (FLT-3 at the end)."""
    return cl.clean_data(reviews_doc(spark, sf))


@register("doc_null_counts", TEXT_CTE + f"""
SELECT 'before' AS step, count(*) FILTER (WHERE {NULL_ANY}) AS null_rows FROM c
UNION ALL SELECT 'after_drug', count(*) FILTER (WHERE {NULL_ANY}) FROM d2
UNION ALL SELECT 'after_text', count(*) FILTER (WHERE {NULL_ANY}) FROM d3""")
def doc_null_counts(spark, sf):
    """AGG-4 / FLT-2 counts printed by clean_data."""
    return cl.clean_data(reviews_doc(spark, sf), with_counts=True)[1]


@register("doc_review_dedup", TEXT_CTE + f"""
SELECT id, drugName, condition FROM (
  SELECT *, row_number() OVER (PARTITION BY review ORDER BY id) rn FROM d3 WHERE {NULL_NONE}) WHERE rn = 1""")
def doc_review_dedup(spark, sf):
    """AGG-6: keep-first dedup on review text."""
    return cl.clean_data(reviews_doc(spark, sf), dedupe_reviews=True).select("id", "drugName", "condition")


@register("doc_semi_join", CLEAN_CTE + """
SELECT id, drugName FROM c WHERE drugName IN (SELECT drugName FROM c WHERE condition = 'en')""")
def doc_semi_join(spark, sf):
    """JN-1: rows whose drug is in a key list."""
    d = _cleaned(spark, sf)
    return cl.semi_join(d.select("id", "drugName"), d.where(F.col("condition") == "en"), "drugName")


def _feature_sql() -> str:
    from reviewlab.operators.sentiment import DEFAULT_LEXICON
    from reviewlab.plans.registry import r_sql
    lex = "lex(w, v) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in DEFAULT_LEXICON.items()) + ")"
    return TEXT_CTE + f""",
cl AS (SELECT * FROM d3 WHERE {NULL_NONE}),
s AS (SELECT avg(word_count) mw, stddev_samp(word_count) sw, avg(upper_count) mu, stddev_samp(upper_count) su,
             avg(usefulCount) mc, stddev_samp(usefulCount) sc FROM cl),
enc AS (SELECT cl.*, CAST(dense_rank() OVER (ORDER BY drugName) - 1 AS INTEGER) AS dcode,
               CAST(dense_rank() OVER (ORDER BY condition) - 1 AS INTEGER) AS ccode FROM cl),
g AS (SELECT dcode, avg(usefulCount) AS a, count(*) AS n FROM enc GROUP BY dcode),
t AS (SELECT sum(n * n) / sum(n) AS avg_n FROM g),
{lex},
tk AS (SELECT id, unnest({tokens_sql('lower(review)')}) AS w FROM cl),
sc2 AS (SELECT tk.id, sum(lex.v) AS sv FROM tk JOIN lex ON tk.w = lex.w GROUP BY tk.id),
sent AS (SELECT enc.id, CAST(CASE WHEN coalesce(sc2.sv, 0) > 0 THEN 2 WHEN coalesce(sc2.sv, 0) < 0 THEN 0 ELSE 1 END AS INTEGER) AS sentiment
         FROM enc LEFT JOIN sc2 ON enc.id = sc2.id)
SELECT enc.id, enc.dcode AS drugName, enc.ccode AS condition, enc.rating,
       {r_sql('(enc.word_count - s.mw) / s.sw')} AS word_count, {r_sql('(enc.upper_count - s.mu) / s.su')} AS upper_count,
       CAST(enc.usefulCount > g.a AS INTEGER) AS reviewQuality,
       {r_sql('(enc.usefulCount - s.mc) / s.sc')} AS usefulStandardized,
       CAST(g.n > t.avg_n AS INTEGER) AS reviewFrequency, sent.sentiment,
       CAST(sent.sentiment = 1 AS INTEGER) AS dummy_sentiment_1, CAST(sent.sentiment = 2 AS INTEGER) AS dummy_sentiment_2
FROM enc JOIN g ON enc.dcode = g.dcode JOIN sent ON enc.id = sent.id, s, t"""


@register("doc_feature_engineering", _feature_sql())
def doc_feature_engineering(spark, sf):
    """PIPE-2 on PIPE-1's output: codes, z-scores, quality/frequency flags, sentiment, dummies."""
    from reviewlab.operators.features import feature_engineering
    from reviewlab.plans.registry import rnd
    d = feature_engineering(cl.clean_data(reviews_doc(spark, sf)), categorical=("drugName", "condition"))
    return d.select("id", "drugName", "condition", "rating", rnd("word_count").alias("word_count"),
                    rnd("upper_count").alias("upper_count"), "reviewQuality",
                    rnd("usefulStandardized").alias("usefulStandardized"), "reviewFrequency", "sentiment",
                    "dummy_sentiment_1", "dummy_sentiment_2")
