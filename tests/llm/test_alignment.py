"""Alignment against token-by-token byte ranges and a plain count of pairs."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reviewlab.llm import alignment, bpe
from tests.llm.conftest import frame

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = ["", None, " ", "  a", "a  b", "a\n b", "\t\n x", "<s> hi </s>", "<|endoftext|> x", "<0x41>", "literal ▁ mark", "日本語 テキスト",
         "é 👍🏽 naïve", "a" * 3000, " " * 500, "-" * 700, "word " * 40, "word " * 40]


@pytest.fixture(scope="module")
def sides():
    library = Tokenizer.from_file(BYTES)
    library.no_truncation()
    library.encode_special_tokens = True
    return library, bpe.Bpe(BYTES).bytes_of, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute(rows, sides):
    library, a_bytes, model = sides
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    out, links, pairs = [], [], Counter()
    for doc, text in rows:
        none = (doc, 0, 0, 0, 0, 0, 0, "")
        a, b = (library.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        own = [a_bytes[i] for i in a], [pieces[i] for i in b]
        if not text or any(b"".join(x) != b" " + text.encode() for x in own):
            out.append(none)
            links.append([])
            continue
        ends = [np.cumsum([len(p) for p in x]).tolist() for x in own]
        spans = [list(zip([0, *e], e)) for e in ends]
        found, j = [], 0
        for i, (lo, hi) in enumerate(spans[0]):
            while j and spans[1][j][0] > lo:
                j -= 1
            while j < len(b) and spans[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < hi:
                found.append((a[i], b[k]))
                k += 1
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = defaultdict(lambda: ([], []))
        for side, ids in enumerate((a, b)):
            for i, e in zip(ids, ends[side]):
                groups[bisect.bisect_left(cuts, e)][side].append(str(i))
        text_ = ";".join(",".join(x) + "|" + ",".join(y) for x, y in (groups[g] for g in range(len(cuts))))
        out.append((doc, len(a), len(b), len(cuts), len(found), 0, 0, hashlib.sha256(text_.encode()).hexdigest()))
        links.append(found)
        pairs.update(found)
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return sorted((o[:5] + (sum(pairs[x] == best[x[1]] for x in own), sum(pairs[x] for x in own), o[7]) for o, own in zip(out, links)), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


def test_matches_brute_force(spark, documents, sides):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000 + i, t) for i, t in enumerate(EDGES)] + [(None, "no id"), (1, "id twice")]
    df = frame(spark, rows, "doc_id long, text string, chunk string, radix int, id string")
    assert rows_of(alignment.align(df, BYTES, PIECES)) == brute(rows, sides)


def test_many_runs_and_blocks_change_nothing(spark, documents, sides, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.limit(60).collect()]

    class Small(alignment.Pair):
        """Sets what module functions read in the tasks."""

        def __call__(self):
            alignment.BLOCK, alignment.HELD = 50, 2000
            return super().__call__()
    monkeypatch.setattr(alignment, "Pair", Small)
    monkeypatch.setattr(alignment, "LINKS", 3000)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 4000)
    runs = alignment.write_runs(frame(spark, rows), Small(BYTES, PIECES), 3)
    assert runs.select("chunk").distinct().count() > 8
    assert rows_of(alignment.align(frame(spark, rows), BYTES, PIECES)) == brute(rows, sides)


def test_merge_is_a_count():
    rng = np.random.default_rng(2)
    total, spill, runs, own = Counter(), alignment.Spill(), [], []
    spill._left = 4000
    for i in range(9):
        keys = np.unique(rng.integers(0, 4000, rng.integers(0, 3000)).astype(np.uint64))
        counts = rng.integers(1, 9, len(keys)).astype(np.uint64)
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(alignment.Run(i, alignment._blocks(keys, counts), spill))
        own.append(keys)
    block, alignment.BLOCK = alignment.BLOCK, 37
    try:
        steps = list(alignment.merged(runs))
    finally:
        alignment.BLOCK = block
    keys = np.concatenate([k for k, _ in steps])
    assert (np.diff(keys.astype(np.int64)) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([t for _, t in steps]).tolist())) == dict(total)
    for run, mine in zip(runs, own):
        assert (np.concatenate([*run.totals, np.zeros(0, np.uint64)]) == [total[k] for k in mine.tolist()]).all()
    spill.close()


def test_empty_table(spark):
    assert alignment.align(frame(spark, []), BYTES, PIECES).collect() == []
