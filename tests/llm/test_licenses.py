"""Licence scans against plain string search; changed notices; edges."""

import re

import numpy as np
import pytest

from reviewlab.llm import licenses
from tests.llm.conftest import frame, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(text):
    w = re.findall(WORD, lower_ascii(text))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(spark, rows, schema="doc_id long, text string, hash string"):
    got = licenses.scan(frame(spark, rows, schema)).collect()
    base = sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in got)
    want = []
    for r in rows:
        n, places, lo, hi, labels = brute(r[1])
        want.append((str(r[0]), n, places, str(lo), str(hi), labels))
    assert base == sorted(want)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    return {r.doc_id: r for r in got}


def test_given_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = check(spark, rows)
    assert any(r.n_base for r in got.values())


def test_phrases_notices_and_edges(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    rows = [(1, "MIT License mit-license. The MIT\nLICENSE"), (2, "general public general public license"), (3, None), (4, ""), (5, "mit"),
            (6, "x " + notice.replace("charge", "any charge") + " y"), (7, "permission is granted to copy this software"),
            (8, "Licensed under CC BY-NC 4.0."), (9, "Licensed under CC BY 4.0"), (10, "é Apache License É" * 3), (11, "mit license " * 30000),
            (1, "MIT License mit-license. The MIT\nLICENSE"), (None, "Apache License"), (12, "apache licenses; the mit licence; mit \x7f license"),
            (13, "GNU Lesser General Public License")]
    got = check(spark, rows)
    assert got[6].labels == "mit" and got[6].base_labels == "" and 0.8 < got[6].score < 1
    assert got[7].labels == "" and got[7].score == 0
    assert got[8].labels == "cc-by-nc" and got[9].labels == "cc-by"
    assert got[13].labels == "gpl,lgpl" and got[13].base_labels == "gpl"
    assert licenses.scan(frame(spark, [])).collect() == []


@pytest.mark.parametrize("drop", [3, 8])
def test_neighbouring_diagonals_merge(spark, drop):
    words = licenses.NOTICES[0][0].split()
    text = " ".join(words[:drop] + words[drop + 1:])
    got = licenses.spans(frame(spark, [(1, "a b c " + text)])).collect()
    assert [(r.label, r.start) for r in got] == [("mit", 2)]


def aligned(words, notice):
    """The longest alignment of two-word runs: each match later in both than the one before, at most GAP words put in."""
    grams = lambda w: list(zip(w, w[1:]))
    at = [(p, t) for p, g in enumerate(grams(words)) for t, h in enumerate(grams(notice)) if g == h]
    best = {}
    for p, t in at:
        best[p, t] = 1 + max((n for (q, s), n in best.items() if q < p and s < t and (p - q) - (t - s) <= licenses.GAP), default=0)
    return max(best.values(), default=0) / max(1, len(notice) - 1)


def test_notices_need_their_order(spark):
    rng = np.random.default_rng(3)
    notices = [(n.split(), label) for n, label in licenses.NOTICES]
    rows = []
    for words, _ in notices:
        rows += [words, words[::-1], [w for pair in zip(words[::2], words[1::2]) for w in pair[::-1]]]
        # word pairs kept, their order reversed
        rows.append([w for i in range(len(words) - 2, -1, -2) for w in words[i:i + 2]])
        rows.append([w for x in words for w in (x, "and", "then", "also", "more")])
        rows.append(words * 3)
        rows.append(words[:len(words) // 2] + ["filler"] * 6 + words[len(words) // 2:])
        for _ in range(4):
            own = list(words)
            for _ in range(rng.integers(1, 4)):
                at = rng.integers(len(own))
                own[at:at + 1] = [[], [own[at], "so"], ["other"]][rng.integers(3)]
            rows.append(["before"] * int(rng.integers(0, 5)) + own + ["after"])
    texts = [(i, " ".join(w)) for i, w in enumerate(rows)]
    got = {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.scan(frame(spark, texts)).collect()}
    wrong = []
    for i, words in enumerate(rows):
        want = {label for phrase, label in licenses.PHRASES if f" {phrase} " in f" {' '.join(words)} "}
        want |= {label for notice, label in notices if aligned(words, notice) >= licenses.COVER}
        if got[i] != want:
            wrong.append((" ".join(words), got[i], want))
    assert not wrong, wrong[:3]
    gpl = "version 3 license version public license general public gnu general the gnu under the licensed under"
    assert {r.labels for r in licenses.scan(frame(spark, [(1, gpl)])).collect()} == {""}
