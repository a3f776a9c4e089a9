"""Registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewlab.llm import (
    alignment, bpe, decontaminate, exact_dedup, langid, licenses, minhash, pivots, substring, tokenfile, toxicity, vectorcodes, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files lie; a path is all that the operators take."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register("op1_warc", """
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (SELECT *, CASE WHEN octet_length(body) >= 100 AND page_id <> MIN(page_id) OVER (PARTITION BY body)
                     THEN MIN(page_id) OVER (PARTITION BY body) END AS refers_to
      FROM (SELECT page_id, encode(COALESCE(html, '')) AS body FROM pages))""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as monolithic archives, normalised to a member a record, and read back by offset."""
    return warc.archived(_table(spark, sf_dir, "pages"))


@_register("op2_exact_dedup", """
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
       doc_id = MAX(doc_id) OVER g AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY COALESCE(text, ''))""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of whole texts; the largest doc_id of a group stays."""
    return exact_dedup.dedup_decisions(_table(spark, sf_dir, "documents"))


@_register("op4_passages")
def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share, small changes allowed."""
    return substring.passages(_table(spark, sf_dir, "documents"))


@_register("op5_token_file")
def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word BPE ids of every whole text in Simple-8b shards, read back from the files."""
    return tokenfile.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@_register("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every whole text."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


@_register("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: the best window of each such document and item."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_register("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every whole text, and the text decoded from them."""
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@_register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the labels outside the held-out quarter."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register("op10_minhash")
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.8 or more."""
    return minhash.near_components(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


@_register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from the documents outside the held-out quarter."""
    return langid.identify(_table(spark, sf_dir, "documents"))


@_register("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned over every whole text, with corpus-wide counts of aligned id pairs."""
    return alignment.align(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def _codes_sql() -> str:
    """Codebooks and codes in SQL: every part against all 64 entries, for two rounds and the end."""
    dims = range(4)
    near = " + ".join(f"(v.x{d} - c.x{d}) * (v.x{d} - c.x{d})" for d in dims)
    coords = ", ".join(f"CAST(floor(CAST(embedding[4 * p + {d + 1}] AS DOUBLE) * 256) AS BIGINT) AS x{d}" for d in dims)
    x = ", ".join(f"x{d}" for d in dims)
    # a distance below 2**50 times 64, plus the entry: the smallest has the lowest index among ties
    found = f"""SELECT v.vec_id, v.p, min(({near}) * 64 + c.e) AS m, {", ".join(f"any_value(v.x{d}) AS x{d}" for d in dims)}
                FROM v JOIN c{{k}} c ON v.p = c.p GROUP BY v.vec_id, v.p"""
    moved = f"""SELECT c.p, c.e, {", ".join(f"COALESCE(s.x{d}, c.x{d}) AS x{d}" for d in dims)} FROM c{{k}} c LEFT JOIN (
                SELECT p, m % 64 AS e, {", ".join(f"CAST(floor(sum(x{d})::DOUBLE / count(*)) AS BIGINT) AS x{d}" for d in dims)} FROM a{{k}} GROUP BY 1, 2) s
                ON c.p = s.p AND c.e = s.e"""
    return f"""
WITH kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT vec_id, p, {coords} FROM kept, range(16) AS parts(p)),
c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, {x} FROM v QUALIFY e < 64),
a0 AS ({found.format(k=0)}), c1 AS ({moved.format(k=0)}),
a1 AS ({found.format(k=1)}), c2 AS ({moved.format(k=1)}),
a2 AS ({found.format(k=2)}),
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(m % 64 AS INT)), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
made AS (SELECT sha256(string_agg(concat_ws(',', {x}), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), made"""


@_register("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors, nearest entries by sliced and intersected bitmasks."""
    return vectorcodes.encode(_table(spark, sf_dir, "embeddings"))


@_register("op13_near_vectors")
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of cosine 0.95 or more, retrieved by shared pivots and verified; links and components."""
    return pivots.near_vectors(_table(spark, sf_dir, "embeddings"))
