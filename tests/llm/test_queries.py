"""The registered queries over whole tables: columns, types and rows, against DuckDB or brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlab.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL
from tests.llm import test_licenses, test_minhash, test_substring

COLUMNS = {
    "op1_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op2_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op3_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_token_file": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op6_licenses": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op8_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
}


@pytest.fixture(scope="module")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns_and_one_row_each(spark, name):
    out = QUERIES[name](spark, SMALL)
    types = dict(out.dtypes)
    for field in COLUMNS[name].split(", "):
        column, kind = field.split(" ")
        assert types[column] == kind, (name, column)
    key = COLUMNS[name].split(" ")[0]
    table = "pages" if key == "page_id" else "documents"
    ids = sorted(r[0] for r in out.select(key).collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())


@pytest.mark.parametrize("name", ORACLE)
def test_queries_match_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_tokens_match_the_library(spark, rows):
    word, byte = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    want, start = {}, 0
    for doc, text in sorted(rows):
        ids = np.array(word.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want[doc] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_file"](spark, SMALL).collect()} == want
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op8_bpe"](spark, SMALL).collect()}
    for doc, text in rows:
        ids = np.array(byte.encode(text, add_special_tokens=False).ids, "<u4")
        back = byte.decode(ids.tolist(), skip_special_tokens=False)
        assert got[doc] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_components_match_all_pairs(spark, rows):
    want = test_minhash.brute(rows, 4, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_minhash"](spark, SMALL).collect()}
    assert got == {rows[i][0]: v for i, v in want.items()}


def test_licences_match_plain_search(spark, rows):
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in QUERIES["op6_licenses"](spark, SMALL).collect()}
    assert got == {doc: test_licenses.brute(text) for doc, text in rows}


def test_leaks_hold_their_items(spark, documents):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    flat = lambda t: " ".join(t.lower().split())
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, SMALL).collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if flat(x) in flat(t)}
    assert exact and exact <= got


def test_passages_share_most_words(spark, rows):
    words = {doc: [w for w in test_substring.alnum(text)] for doc, text in rows}
    got = QUERIES["op4_passages"](spark, SMALL).collect()
    assert got
    for r in got:
        own, its = set(words[r.doc_id][r.first_word:r.last_word + 1]), set(words[r.other_id][r.other_first:r.other_last + 1])
        assert r.doc_id != r.other_id and r.n_words >= 50 and len(own & its) >= 0.6 * max(len(own), len(its))
    linked = {x for r in got for x in (r.doc_id, r.other_id)}
    grams = {}
    for doc, w in words.items():
        for i in range(len(w) - 59):
            grams.setdefault(tuple(w[i:i + 60]), set()).add(doc)
    repeated = {d for docs in grams.values() if len(docs) > 1 for d in docs}
    assert repeated <= linked


def test_scores_on_the_held_out_quarter(spark, documents):
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = [r for r in QUERIES["op3_language_id"](spark, SMALL).collect() if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in QUERIES["op9_toxicity"](spark, SMALL).collect())
