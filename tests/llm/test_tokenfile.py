"""Simple-8b round trips, and ids against the public tokenizers library."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewlab.llm import simple8b, tokenfile
from tests.llm.conftest import frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=200, deadline=None)
def test_blocks_round_trip(ids):
    words, exceptions = simple8b.encode(np.array(ids, np.uint64))
    assert simple8b.decode(words, exceptions).tolist() == ids


def test_packing_is_dense_and_special_words_are_used():
    assert len(simple8b.encode(np.zeros(480, np.uint64))[0]) == 2
    assert len(simple8b.encode(np.full(600, 40_000, np.uint64))[0]) == 200
    words, exceptions = simple8b.encode(np.array([1 << 61, 5, (1 << 60) - 1], np.uint64))
    assert exceptions.tolist() == [1 << 61] and len(words) == 3


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


def test_shards_read_by_range():
    rng = np.random.default_rng(1)
    counts = [0, 5, 1000, 1, 0, 700]
    ids = rng.integers(0, 49_408, sum(counts), dtype=np.uint64)
    f = _File()
    simple8b.write_shard(f, [1, None, -5, 7, 8, 2**62], counts, ids, block_ids=64)
    shard, at = simple8b.Shard(f), 0
    assert shard.doc_ids == [1, None, -5, 7, 8, 2**62] and shard.counts.tolist() == counts
    for n in counts:
        assert shard.ids(at, n).tolist() == ids[at:at + n].tolist()
        at += n


EDGES = ["", " ", "It's. It's, we'll! OK?", "a...b. c..", "x<|endoftext|>. y <|startoftext|>", "\t\x0b a\x85b\xa0c d", "Éa É. ́e ́x", "日本。 語",
         "don't.\n\n\nNow", "123 4567a89.", "ΣΑΣ. Σ", "\x1c\x1d x", "w" * 3000, "A. B, C; D: E! F?", ". , ;", "İ. İ.", "ﬁ. ǅ!"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_match_the_library(library):
    rng = np.random.default_rng(2)
    texts = EDGES + ["".join(rng.choice(list("aB '\n\ts.é中!1,　́"), 14)) for _ in range(1500)]
    texts += ["".join(map(chr, range(i, i + 40))) for i in range(1, 0xD7C0, 40)]
    own = tokenfile.Words(PATH)
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_files_match_brute_force(spark, library, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(5000 - i, t) for i, t in enumerate(EDGES)] + [(-3, None), (9_000_000_000, "last")]
    want, start = {}, 0
    for doc, text in sorted(rows):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[doc] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = tokenfile.round_trip(frame(spark, rows, "doc_id long, text string, start string"), PATH, shard_ids=20_000).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(rows)
    assert tokenfile.round_trip(frame(spark, []), PATH).collect() == []


def test_null_and_repeated_ids(spark):
    got = tokenfile.round_trip(frame(spark, [(None, "a"), (1, "b"), (1, "b"), (2, None)]), PATH).collect()
    assert sorted((r.start, str(r.doc_id), r.n_tokens) for r in got) == [(0, "None", 2), (2, "1", 2), (4, "1", 2), (6, "2", 1)]
