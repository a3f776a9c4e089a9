"""BPE against the public tokenizers library, id by id."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlab.llm import bpe
from tests.llm.conftest import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


EDGES = ["", " ", "  a", "a  b", "a\n b", "a \nb", " lead", "it's we'll I'M 'S", "x<|endoftext|> y<|endoftext|>", "\t\n\r\x0b\x0c\x85\xa0  x",
         "a" * 4000, "日本語 テキスト", "é 👍🏽", "don't  stop\n\n\n  now ", "\x1c\x1d \x1ea", "<|endoftext|>", "...  ---", "end. Next, one; two: 3.",
         "word.\nNext", "\x00 \x01", "é. É, ñ!", "a.b. c.. d!? '. '"]


def test_texts_match_the_library(library):
    own = bpe.Bpe(PATH)
    rng = np.random.default_rng(3)
    texts = EDGES + ["".join(rng.choice(list("ab '\n\ts.é中!1　\x85"), 14)) for _ in range(1500)]
    texts += ["".join(map(chr, range(i, i + 40))) for i in range(1, 0xD7C0, 40)]
    for text in texts:
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_decoding_broken_ids(library):
    own = bpe.Bpe(PATH)
    ids = np.array([255, 50256, 10, 162, 220], "<u4")
    assert own.decode(ids.tobytes()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_query_rows(spark, library, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000 + i, t) for i, t in enumerate(EDGES)] + [(1, None), (None, "x")]
    rows = [(i, t) for i, t in rows if t is None or "\x00" not in t]
    got = bpe.digests(frame(spark, rows, "doc_id long, text string, ids string"), PATH).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.digests(frame(spark, []), PATH).collect() == []


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "PIECES", 3)
    own = bpe.Bpe(PATH)
    text = "some words, and some more words; and some. " * 5
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_full_memory_keeps_what_is_still_met(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 4)
    own, asked = bpe.Bpe(PATH), []
    merge = own.merge
    monkeypatch.setattr(own, "merge", lambda piece: asked.append(piece) or merge(piece))
    own.encode("".join(f" common {x}" for x in ("one", "two", "three", "four", "five", "six", "seven")))
    assert asked.count(b" common") == 1
    assert len(own._words) + len(own._words.older) <= 4


def test_digests_come_from_one_worker_a_task(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame(spark, [(1, "Some text, twice. Some text"), (2, None), (3, ""), (4, "\u00e9\u00e8 \u4e2d<|endoftext|> x")])
    out = bpe.digests(docs, path)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    both = bpe.decode(bpe.encode(docs, path), path).collect()
    assert {tuple(r) for r in bpe.round_trip(docs, path).collect()} == {tuple(r) for r in both} and len(both) == 4
