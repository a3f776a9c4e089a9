"""Exact dedup against grouping the texts themselves."""

import hashlib

import pytest

from reviewlab.llm import exact_dedup
from tests.llm.conftest import frame

LONG = "x" * 100
ROWS = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, LONG + "1"), (7, LONG + "2"), (8, LONG + "1"), (9, "é"), (10, "é"), (11, "é "),
        (2, "a"), (None, "b"), (None, "lone"), (12, "A"), (13, LONG * 3000), (14, LONG * 3000), (15, "ab"), (16, "ba"), (1, "other text of a repeated id")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else i
        out.append((str(i), str(keep), len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("broadcast_ids", [500_000, 0])
def test_decisions_match_brute_force(spark, broadcast_ids):
    docs = frame(spark, ROWS, "doc_id long, text string, keep_id string")
    got = exact_dedup.dedup_decisions(docs, broadcast_ids=broadcast_ids).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == brute(ROWS)
    left = exact_dedup.exact_dedup(docs, broadcast_ids=broadcast_ids)
    assert left.columns == docs.columns
    want = sorted((str(i), t or "") for i, t in ROWS if (str(i), True) in {(x[0], x[3]) for x in brute(ROWS) if x[4] == hashlib.sha256((t or "").encode()).hexdigest()})
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == want


def test_empty_and_without_repeats(spark):
    assert exact_dedup.dedup_decisions(frame(spark, [])).collect() == []
    assert exact_dedup.exact_dedup(frame(spark, [])).collect() == []
    got = exact_dedup.dedup_decisions(frame(spark, [(1, "a"), (2, "bb")])).collect()
    assert all(r.kept and r.group_size == 1 for r in got)


def test_given_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = exact_dedup.dedup_decisions(documents).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == brute(rows)
