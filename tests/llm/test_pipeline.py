"""The pipeline against a brute-force version of its stages over a small fixture."""

import hashlib
import tempfile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reviewlab.llm import langid
from tests.llm import test_decontaminate, test_minhash
from tests.llm.conftest import frame


@pytest.fixture(scope="module")
def tables(spark, documents):
    """Short documents with copies, near copies, leaks, nulls and further columns, as a folder of tables."""
    folder = tempfile.mkdtemp(prefix="reviewlab-pipeline-", dir="/tmp")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").limit(6)
    docs = documents.where(F.length("text") < 1500).orderBy("doc_id").limit(70).withColumn("n", F.lit(None).cast("string"))
    rows = [tuple(r) for r in docs.collect()]
    texts = [r[1] for r in rows]
    leak = items.first().text
    extra = [(10_000, texts[3]), (10_001, texts[3]), (10_002, texts[5] + " and a tail"), (10_003, texts[7] + "\n" + leak + " " + texts[8]),
             (10_004, None), (10_005, ""), (10_006, "1234 5678"), (10_007, texts[5] + " and a tail"), (10_008, texts[9] + " " + leak.upper())]
    rows += [(i, t, "en", "s", len(t or ""), "x") for i, t in extra]
    spark.createDataFrame(rows, docs.schema).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_matches_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    rejected = {r.doc_id for r in langid.identify(docs).collect() if r.rejected}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in rejected}
    assert {10_004, 10_005, 10_006} <= rejected and len(rows) > 60
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    rows = {i: t for t, i in last.items()}
    listed = sorted(rows.items())
    near = test_minhash.brute(listed, 5, 80)
    rows = {i: t for j, (i, t) in enumerate(listed) if near[j][1] == i}
    assert len(rows) < len(listed)
    leaks = {d for d, _ in test_decontaminate.brute(sorted(rows.items()), items)}
    assert leaks
    rows = {i: t for i, t in rows.items() if i not in leaks}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, t in rows.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, tables).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_stages_keep_columns_and_take_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, tables)
            assert out.columns == docs.columns, name
        assert out.count() == 0
    clash = frame(spark, [(1, "some words", "a", "b")], "doc_id long, text string, lang string, lost_id string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clash, tables).columns == clash.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), tables).count() == 0
