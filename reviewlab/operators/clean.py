"""Cleaning and imputation (FLT-1..6, AGG-5..7, JN-1..5, PIPE-1).

Rows are identified by an explicit ``id`` column; "first" always means the
smallest id.  Only rows that hold a null travel through the imputation joins;
the complete rows pass straight through and are unioned back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.automaton import last_patterns
from reviewlab.session import cut_lineage
from reviewlab.functions.text import (
    EXCLUDED_CONDITIONS, HELPFUL_MARKER, clean_review, clean_text, is_marker, upper_word_count, word_count,
)

# Splits text into alternating maximal runs of [a-z] and of other characters.
_RUN_SPLIT = "(?<=[a-z])(?=[^a-z])|(?<=[^a-z])(?=[a-z])"


def any_null(df: DataFrame, cols=None) -> Column:
    cols = cols or df.columns
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def null_marker(df: DataFrame, col: str = "condition", marker: str = HELPFUL_MARKER) -> DataFrame:
    """FLT-1: null out values that contain the marker text."""
    return df.withColumn(col, F.when(~is_marker(F.col(col), marker), F.col(col)))


def rows_with_null(df: DataFrame) -> DataFrame:
    """FLT-2."""
    return df.where(any_null(df))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """FLT-3."""
    return df.na.drop("any")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """FLT-4: distinct non-null values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def exclude_values(df: DataFrame, col: str, values=EXCLUDED_CONDITIONS) -> DataFrame:
    """FLT-6."""
    return df.where(~F.col(col).isin(list(values)))


def keep_first(df: DataFrame, keys, order: str = "id") -> DataFrame:
    """AGG-5/AGG-6: keep the row with the smallest ``order`` per key.

    ``min_by`` is an ordinary aggregate with a map-side partial step, so a key
    holding a third of all rows is folded before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return agg.select(*[F.col(k) if k in keys else F.col(f"_r.{k}").alias(k) for k in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG-7."""
    return df.distinct()


def semi_join(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """JN-1: rows whose ``col`` is in ``keys``."""
    return df.join(keys.select(col).distinct(), col, "left_semi")


def upsert(df: DataFrame, changed: DataFrame, key: str = "id") -> DataFrame:
    """JN-5: replace rows of ``df`` by the rows of ``changed`` with the same key."""
    kept = df.join(changed.select(key), key, "left_anti")
    return kept.unionByName(changed.select(*df.columns))


def decode(df: DataFrame, col: str, dim: DataFrame, code_col: str, name_col: str) -> DataFrame:
    """JN-4: codes back to names through a (code, name) dimension."""
    d = dim.select(F.col(code_col).alias("_code"), F.col(name_col).alias("_name"))
    j = df.join(d, F.col(col) == F.col("_code"), "left")
    return j.select(*[F.col("_name").alias(c) if c == col else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- JN-2
def drug_lookup(df: DataFrame, key: str = "drugName", value: str = "condition", order: str = "id", how: str = "first") -> DataFrame:
    """(key, value): with ``first`` that of the first row for the key, which may be null; with ``mode`` the
    most common one that isn't null, of equally common ones that which appears first."""
    if how == "first":
        return keep_first(df.where(F.col(key).isNotNull()).select(order, key, value), [key]).select(key, value)
    if how != "mode":
        raise ValueError(f"how must be first or mode, not {how!r}")
    counts = (df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value)
              .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first")))
    # the smallest of (-count, first row)
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_first"))).alias(value))


def impute_by_key(rows: DataFrame, lookup: DataFrame, key: str = "drugName", value: str = "condition") -> DataFrame:
    """JN-2 applied to rows that hold a null: ``value`` := lookup[key]."""
    lk = lookup.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = rows.join(lk, F.col(key) == F.col("_k"), "left")
    return j.select(*[F.col("_v").alias(c) if c == value else F.col(c) for c in rows.columns])


# ---------------------------------------------------------------- JN-3
def condition_order(df: DataFrame, col: str = "condition", order: str = "id") -> DataFrame:
    """Known conditions with their first-appearance key, stop values removed."""
    known = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order).alias("first_id"))
    return exclude_values(known, col)


def match_conditions(rows: DataFrame, conds: DataFrame, id_col: str = "id", text: str = "review",
                     cond: str = "condition") -> DataFrame:
    """JN-3: (id, condition) = the last condition, in first-appearance order,
    whose pattern ``[^a-z]cond[^a-z|s]`` occurs in the text.

    Conditions that begin and end with a letter a-z can only match whole runs
    of a-z characters, so their matches are found by an equi-join between the
    conditions and the run sequences of each text (t runs for a condition of
    t runs).  All others are found by one walk of an automaton over each text.
    """
    spark = rows.sparkSession
    # the ordered condition list is small; materialise it once so the driver
    # queries below do not recompute it from the full table
    c = cut_lineage(conds.select(F.col(cond).alias("_c"), "first_id"))
    regular = c.where(F.col("_c").rlike("^[a-z](.*[a-z])?$")).withColumn(
        "_runs", F.size(F.regexp_extract_all("_c", F.lit("[a-z]+"), 0)))
    irregular = c.where(~F.col("_c").rlike("^[a-z](.*[a-z])?$"))
    shape = (c.withColumn("_reg", F.col("_c").rlike("^[a-z](.*[a-z])?$"))
             .groupBy("_reg").agg(F.collect_set(F.size(F.regexp_extract_all("_c", F.lit("[a-z]+"), 0))).alias("runs"),
                                  F.count(F.lit(1)).alias("n")).collect())  # at most two rows
    run_counts = sorted(next((r["runs"] for r in shape if r["_reg"]), []))
    n_irr = next((r["n"] for r in shape if not r["_reg"]), 0)

    parts = []
    if run_counts:
        toks = rows.select(id_col, F.split(F.col(text), _RUN_SPLIT).alias("_t"))
        per_t = []
        for t in run_counts:
            span = 2 * t - 1
            cands = F.expr(
                f"transform(filter(sequence(2, greatest(size(_t) - {span}, 2)), "
                f"i -> i + {span} <= size(_t) AND substr(element_at(_t, i), 1, 1) rlike '[a-z]' "
                f"AND substr(element_at(_t, i + {span}), 1, 1) != '|'), "
                f"i -> array_join(slice(_t, i, {span}), ''))")
            per_t.append(cands)
        all_cands = F.array_distinct(F.flatten(F.array(*per_t))) if len(per_t) > 1 else F.array_distinct(per_t[0])
        exploded = toks.select(id_col, F.explode(all_cands).alias("_c"))
        known = regular.select("_c", "first_id")
        # conditions are a dimension: Spark broadcasts them by their size in bytes, and beyond
        # its threshold splits a very frequent candidate's partition
        parts.append(exploded.join(known, "_c"))
    if n_irr:
        hit = last_patterns(rows, irregular, id_col, text, "_c", "first_id")
        parts.append(hit)
    if not parts:
        return spark.createDataFrame([], f"{id_col} bigint, {cond} string")
    allm = reduce(lambda a, b: a.unionByName(b), [p.select(id_col, "_c", "first_id") for p in parts])
    return allm.groupBy(id_col).agg(F.max_by("_c", "first_id").alias(cond))


# ---------------------------------------------------------------- PIPE-1
FLAG, FLAG_OTHER = "_nul", "_nul_other"


def with_null_flags(df: DataFrame) -> DataFrame:
    """FLT-1 on raw rows plus two flags from the raw columns: the row holds a
    null (after the marker rule), and a column other than ``condition`` does.
    Cleaning keeps nulls and creates none, so the flags hold for cleaned rows."""
    d = null_marker(df)
    return d.withColumns({FLAG: any_null(d, df.columns),
                          FLAG_OTHER: any_null(d, [c for c in df.columns if c != "condition"])})


def clean_projection(d: DataFrame, cols) -> DataFrame:
    """STR-5/6/7/8 on an already marker-filtered frame; keeps extra columns."""
    extra = [c for c in d.columns if c not in cols]
    return d.select(
        *[c for c in cols if c not in ("review", "condition", "drugName")],
        clean_text(F.col("drugName")).alias("drugName"),
        clean_text(F.col("condition")).alias("condition"),
        clean_review(F.col("review")).alias("review"),
        word_count(F.col("review")).alias("word_count"),
        upper_word_count(F.col("review")).alias("upper_count"),
        *extra,
    ).select(*cols, "word_count", "upper_count", *extra)


def clean_columns(df: DataFrame, null_flag: str | None = None) -> DataFrame:
    """FLT-1, STR-7, STR-8, STR-5, STR-6 in one projection (optionally with the
    null flags)."""
    d = with_null_flags(df)
    out = clean_projection(d, df.columns)
    return out if null_flag else out.drop(FLAG, FLAG_OTHER)


def impute_conditions(df: DataFrame, clean: bool = True, drop: bool = False):
    """JN-2 then JN-3 (before FLT-3) on raw rows; returns (rows, rows after
    the drug step restricted to the rows that held a null).  With ``drop``
    FLT-3 follows: of the rows without a null on their raw columns, since a
    filter on cleaned columns would clean every text a second time.

    Plan shape at scale: rows without a null are cleaned and stream straight
    to the output - no join, no shuffle.  Only rows holding a null meet the
    drug lookup (one row per drug) and the text match.  The lookup and the
    ordered condition list are aggregates over the narrow columns
    (id, drugName, condition); map-side partial aggregation absorbs hot keys.
    """
    cols = list(df.columns)
    f = with_null_flags(df)
    prep = (lambda x: clean_projection(x, cols)) if clean else (lambda x: x)
    narrow = f.select("id", (clean_text(F.col("drugName")) if clean else F.col("drugName")).alias("drugName"),
                      (clean_text(F.col("condition")) if clean else F.col("condition")).alias("condition"), FLAG)
    lookup = drug_lookup(narrow)
    holes = prep(f.where(F.col(FLAG)))
    lk = lookup.select(F.col("drugName").alias("_k"), F.col("condition").alias("_lk"))
    holes2 = (holes.join(lk, F.col("drugName") == F.col("_k"), "left")
              .withColumn("condition", F.col("_lk")).drop("_k", "_lk")
              .withColumn(FLAG, F.col("condition").isNull() | F.col(FLAG_OTHER)))
    after_drug = (narrow.where(~F.col(FLAG)).select("id", "condition")
                  .unionByName(holes2.select("id", "condition")))
    still = holes2.where(F.col(FLAG)).select("id", "review")
    matched = match_conditions(still, condition_order(after_drug))
    fixed = (holes2.join(matched.withColumnRenamed("condition", "_m"), "id", "left")
             .withColumn("condition", F.coalesce(F.col("_m"), F.col("condition"))).drop("_m"))
    out_cols = cols + (["word_count", "upper_count"] if clean else [])
    complete, fixed = f.where(~F.col(FLAG)), fixed.select(*out_cols)
    if drop:
        complete, fixed = complete.na.drop("any", subset=cols), drop_null_rows(fixed)
    rows = prep(complete).select(*out_cols).unionByName(fixed)
    return rows, holes2.select(*out_cols, FLAG)


def raw_impute(df: DataFrame) -> DataFrame:
    """ASC-5's imputation: no text cleaning, null rows dropped at the end."""
    return drop_null_rows(impute_conditions(df, clean=False)[0])


def clean_data(df: DataFrame, dedupe_reviews: bool = False, with_counts: bool = False):
    """PIPE-1: clean, impute ``condition`` by drug then by text, drop null rows.

    Returns the cleaned DataFrame (and, with ``with_counts``, null-row counts
    before/after each step).
    """
    out, _ = impute_conditions(df, clean=True, drop=True)
    if dedupe_reviews:
        out = keep_first(out, ["review"])
    if not with_counts:
        return out
    rows, holes2 = impute_conditions(df, clean=True)
    f = with_null_flags(df)
    counts = (f.agg(F.lit("before").alias("step"), F.count_if(FLAG).alias("null_rows"))
              .unionByName(holes2.agg(F.lit("after_drug").alias("step"), F.count_if(FLAG).alias("null_rows")))
              .unionByName(rows.agg(F.lit("after_text").alias("step"),
                                    F.count_if(any_null(rows)).alias("null_rows"))))
    return out, counts
