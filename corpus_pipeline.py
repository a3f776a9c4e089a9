"""Corpus pipeline: language, exact and near duplicates, benchmark leaks, then token ids.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet in the
shared folder and read back as the next stage's documents.  All stages but the
last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlab.llm import bpe, decontaminate, exact_dedup, langid, minhash
from reviewlab.llm.queries import tokenizer_path
from reviewlab.llm.storage import stash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language's model accepts."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (5-word shingles, Jaccard 0.8 or more), the document with the smallest id."""
    return minhash.near_dedup(docs, shingle=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of what is left: doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe.digests(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("tokens", tokens)]

#: Language models, MinHash and BPE aren't SQL: tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stash(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
