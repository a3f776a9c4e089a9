"""Stand-in review tables built from the driver's tables (FIXTURES.md §5).

Each adapter has a Spark form and an equivalent SQL form (used by the DuckDB
oracle) so that both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.session import ensure_parallelism, stash
from reviewlab.sources.io import read_table

HELPFUL_TEXT = "3 users found this comment helpful."


def reviews_evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("drugName"),
        F.col("event_type").alias("condition"),
        F.col("value").alias("usefulCount"),
        (F.lit(1) + k % 10).cast("int").alias("rating"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
    )


REVIEWS_EVT_SQL = """
SELECT event_id AS id, CAST(user_id AS VARCHAR) AS drugName, event_type AS condition,
       value AS usefulCount,
       CAST(1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS INTEGER) AS rating,
       strftime(ts, '%Y-%m-%d') AS date
FROM events"""


def reviews_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = ensure_parallelism(docs, keys=["doc_id"]).join(labels, "doc_id", "left")
    cond = (F.when(F.col("doc_id") % 17 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 29 == 0, F.lit(HELPFUL_TEXT))
            .otherwise(F.col("lang")))
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("drugName"),
        cond.alias("condition"),
        F.col("text").alias("review"),
        (F.when(F.col("quality") == 1, 6).otherwise(1) + F.col("doc_id") % 5).cast("int").alias("rating"),
        F.col("n_chars").alias("usefulCount"),
    )


REVIEWS_DOC_SQL = f"""
SELECT d.doc_id AS id, d.source AS drugName,
       CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN d.doc_id % 29 = 0 THEN '{HELPFUL_TEXT}'
            ELSE d.lang END AS condition,
       d.text AS review,
       CAST(CASE WHEN l.quality = 1 THEN 6 ELSE 1 END + d.doc_id % 5 AS INTEGER) AS rating,
       d.n_chars AS usefulCount
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels (inner): the rows that carry a class label."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic (label, probability, prediction) table with ties."""
    d = labelled_docs(spark, sf_dir)
    p = ((F.col("doc_id") * 37 + 50 * F.col("quality")) % 100) / 100.0
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("int").alias("label"),
        p.cast("double").alias("probability"),
        (p >= 0.5).cast("int").alias("prediction"),
    )


SCORES_SQL = """
SELECT d.doc_id AS id, CAST(l.quality AS INTEGER) AS label,
       CAST(((d.doc_id * 37 + 50 * l.quality) % 100) / 100.0 AS DOUBLE) AS probability,
       CAST(((d.doc_id * 37 + 50 * l.quality) % 100) / 100.0 >= 0.5 AS INTEGER) AS prediction
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def points_emb(spark: SparkSession, sf_dir: str, dims: int = 4) -> DataFrame:
    """Embeddings with the first ``dims`` coordinates spread to x1..xd."""
    e = read_table(spark, sf_dir, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(f"x{i + 1}") for i in range(dims)]
    return e.select(F.col("vec_id").alias("id"), *cols, F.col("label").cast("int").alias("label"))


def points_emb_sql(dims: int = 4) -> str:
    cols = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i + 1}" for i in range(dims))
    return f"SELECT vec_id AS id, {cols}, CAST(label AS INTEGER) AS label FROM embeddings"


def vectors_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a double array column ``v`` (all dimensions)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.col("embedding").cast("array<double>").alias("v"),
                    F.col("label").cast("int").alias("label"))


VECTORS_EMB_SQL = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS INTEGER) AS label FROM embeddings"


def split_bucket(id_col: str = "id") -> F.Column:
    """SMP-1 deterministic 80/20 split key: md5 bucket of the id, 0 = test."""
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint") % 5


def split_bucket_sql(id_col: str = "id") -> str:
    return f"(('0x' || substr(md5(CAST({id_col} AS VARCHAR)), 1, 8))::BIGINT % 5)"


def features_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as z-scored features (word_count, upper_count, useful) + label.

    Texts are counted once and the counts written: whoever reads the features would otherwise split all texts again.
    """
    from reviewlab.functions.text import upper_word_count, word_count
    from reviewlab.operators.features import standardize
    d = ensure_parallelism(labelled_docs(spark, sf_dir), keys=["doc_id"])
    f = d.select(F.col("doc_id").alias("id"), word_count(F.col("text")).alias("word_count"),
                 upper_word_count(F.col("text")).alias("upper_count"),
                 F.col("n_chars").cast("double").alias("useful"), F.col("quality").cast("int").alias("label"))
    return standardize(stash(f, "doc-features"), ["word_count", "upper_count", "useful"], ddof=1)


def features_doc_sql() -> str:
    from reviewlab.plans.sqltext import upper_count_sql, word_count_sql
    return f"""SELECT id, (wc - avg(wc) OVER ()) / stddev_samp(wc) OVER () AS word_count,
  (uc - avg(uc) OVER ()) / stddev_samp(uc) OVER () AS upper_count,
  (nc - avg(nc) OVER ()) / stddev_samp(nc) OVER () AS useful, label
FROM (SELECT d.doc_id AS id, {word_count_sql('d.text')} AS wc, {upper_count_sql('d.text')} AS uc,
             CAST(d.n_chars AS DOUBLE) AS nc, CAST(l.quality AS INTEGER) AS label
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
