"""Decontamination against every window of every document compared with every item."""

import re

from reviewlab.llm import decontaminate
from tests.llm.conftest import frame

K = 5


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(w):
    k = min(K, len(w))
    out = {}
    for i in range(len(w) - k + 1):
        s = tuple(w[i:i + k])
        out[s] = out.get(s, 0) + sum(len(x.encode()) + 1 for x in s)
    return out


def brute(docs, items, threshold=0.8):
    """{(doc_id, item_id): best similarity}"""
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            own = words(item)
            b = bag(own)
            for at in range(len(w) - len(own) + 1) if own else ():
                a = bag(w[at:at + len(own)])
                keys = a.keys() | b.keys()
                sim = sum(min(a.get(x, 0), b.get(x, 0)) for x in keys) / sum(max(a.get(x, 0), b.get(x, 0)) for x in keys)
                if sim >= threshold - 1e-9:
                    out[d, i] = max(out.get((d, i), 0), sim)
    return out


def check(spark, docs, items, **options):
    got = decontaminate.contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string, doc_id string"), **options).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    return got


ITEM = " ".join(f"word{i} of{i % 7}" for i in range(30))


def test_windows_match_brute_force(spark):
    w = ITEM.split()
    filler = " ".join(f"f{i}" for i in range(200))
    changed = w[:]
    changed[-2] = "edit"
    broken = w[:]
    broken[10] = broken[30] = broken[50] = "edit"
    items = [(1, ITEM), (2, " ".join(w[:20])), (3, "four words only here"), (4, ""), (5, None), (6, "a b a b a b a b a b"),
             (7, "É lan vital où ça"), (8, " ".join(f"z{i}" for i in range(70)))]
    docs = [(1, f"{filler} {ITEM} {filler}"), (2, ITEM.upper().replace(" ", ",\n ")), (3, f"{filler} {' '.join(changed)}"),
            (4, f"{filler} {' '.join(broken)} x"), (5, " ".join(w[:24])), (6, "Four “words” only—here!"), (7, None), (8, ""),
            (9, "a b a b a b a b a b a b"), (10, "é Lan VITAL où Ça"), (11, filler), (12, "b a b a"),
            (13, (ITEM + " x ") * 300), (14, " ".join(f"z{i}" for i in range(2, 75)))]
    check(spark, docs, items)
    check(spark, docs, items, block_shingles=40)


def test_given_tables(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect() if len(r.text) < 3000]
    assert check(spark, rows, items)


def test_stage_drops_only_leaks_and_takes_empty_tables(spark):
    docs = frame(spark, [(1, "x " + ITEM, "a"), (2, "clean text that is not in it", "b"), (2, ITEM, "c"), (None, ITEM, "d"), (3, None, "e")],
                 "doc_id long, text string, similarity string")
    items = frame(spark, [(1, ITEM)], "item_id long, text string")
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.similarity) for r in left.collect()) == [(2, "b"), (3, "e")]
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 5
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


def test_a_text_shorter_than_the_item_is_compared_as_a_whole(spark):
    item = ITEM.split()[:59]
    docs = [(1, " ".join(item[:52])), (2, " ".join(item[4:])), (3, " ".join(item[:40])), (4, "word0 of0"), (5, " ".join(item))]
    got = decontaminate.contaminated(frame(spark, docs), frame(spark, [(1, " ".join(item))], "item_id long, text string")).collect()
    want = {}
    for i, text in docs:
        a, b = bag(words(text)), bag(item)
        want[i] = sum(min(a.get(x, 0), b[x]) for x in b) / sum(max(a.get(x, 0), b.get(x, 0)) for x in a.keys() | b.keys())
    assert {r.doc_id: round(r.similarity, 9) for r in got} == {i: round(v, 9) for i, v in want.items() if v >= 0.8}
    assert {r.doc_id: r.n_words for r in got} == {1: 52, 2: 55, 5: 59}
