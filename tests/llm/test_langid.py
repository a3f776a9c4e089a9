"""Kneser-Ney models against a plain dictionary version; held-out accuracy."""

from collections import Counter

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from reviewlab.llm import langid
from reviewlab.llm.langid import ORDER, _fold, kneser_ney, symbols
from reviewlab.llm.textkernel import slices
from tests.llm.conftest import frame


def plain_symbols(text):
    out = []
    for c in text:
        s = _fold(c)
        if s or (out and out[-1]):
            out.append(s)
    return out


def grams(texts):
    seen = Counter()
    for t in texts:
        s = [0, 0, 0] + plain_symbols(t)
        seen.update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    return seen


def plain_model(texts):
    """p(symbol | context) straight from the definition."""
    count = {ORDER: grams(texts)}
    for order in range(ORDER - 1, 0, -1):
        count[order] = Counter(g[1:] for g in count[order + 1])

    def discount(c):
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    d = {o: discount(c) for o, c in count.items()}

    def p(gram):
        o, c = len(gram), count[len(gram)]
        own = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        low = p(gram[1:]) if o > 1 else 1 / 64
        if not own:
            return low
        total = sum(own.values())
        return max(own.get(gram, 0) - d[o], 0) / total + sum(min(v, d[o]) for v in own.values()) / total * low
    return p


TEXTS = {"xx": ["Banana band, and a ban!", "bandana", "Ä ß nab"], "yy": ["the cat sat on the mat", "then that hat..."]}
PROBE = ["a band", "the  bandana cat", "zzz", "ñandú 中文 字", "", "12 .", "\U0001d4d0b", "A"]


def model():
    out = {}
    for lang, texts in TEXTS.items():
        c = grams(texts)
        out[lang] = (np.array([sum(s << 6 * (3 - i) for i, s in enumerate(g)) for g in c]), np.array(list(c.values())))
    return kneser_ney(out)


def test_symbols_of_slices():
    texts = [*PROBE, None, " x ", "--", "é!"]
    for a, b, buf, offsets in slices(pa.array(texts)):
        codes, first = symbols(buf, offsets)
        for r in range(a, b):
            s = [0, 0, 0] + plain_symbols(texts[r] or "")
            want = [sum(x << 6 * (3 - i) for i, x in enumerate(s[j - 3:j + 1])) for j in range(3, len(s))]
            assert codes[first[r - a]:first[r - a + 1]].tolist() == want


def test_probabilities_match_the_definition():
    m = model()
    plain = {lang: plain_model(t) for lang, t in TEXTS.items()}
    for text in PROBE + TEXTS["xx"]:
        s = [0, 0, 0] + plain_symbols(text)
        for i in range(3, len(s)):
            code = np.array([sum(x << 6 * (3 - k) for k, x in enumerate(s[i - 3:i + 1]))], np.uint32)
            for j, lang in enumerate(m.languages):
                assert abs(np.exp(m.log_probs(code)[0, j]) - plain[lang](tuple(s[i - 3:i + 1]))) < 1e-5


def test_probabilities_sum_to_one():
    m = model()
    for head in (0, 1, 2 << 12 | 1 << 6 | 14, 63 << 12):
        total = np.exp(m.log_probs((np.arange(64) + (head << 6)).astype(np.uint32)).astype(float)).sum(0)
        assert np.allclose(total, 1, atol=1e-4)


def test_held_out_accuracy_and_clean_documents_stay(spark, documents):
    out = langid.identify(documents)
    rows = out.join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == documents.count() and len(held) > 20
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.keep_identified(documents).count() >= 0.98 * len(rows)


def test_edges(spark):
    rows = [(i, f"the cat sat on the mat and then number {i} ran to that hat", "yy", "e") for i in range(30)]
    rows += [(100 + i, f"banana bandana {'banda ' * (i % 5)} nab ban", "xx", "e") for i in range(30)]
    rows += [(200, None, "xx", None), (201, "", None, None), (202, "123 ...", "yy", None), (None, "the mat", "xx", None),
             (203, "the cat sat " * 20000, None, None), (1, rows[1][1], "yy", "e"),
             (204, "qxz jvk wqz pfft xkcd " * 50, None, None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string, score string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[200].score == 0 and by[202].rejected
    assert by[203].lang_pred == "yy" and by[None].lang_pred == "yy" and not by[None].held_out and by[204].rejected
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert left.count(1) == 2 and 204 not in left and 200 not in left and 203 in left
    empty = docs.limit(0)
    assert langid.identify(empty).collect() == [] and langid.keep_identified(empty).collect() == []
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"} and sum(r.rejected for r in unlabelled) == 3


def test_limits_are_settled_by_no_single_row_and_hold_for_rare_languages(spark):
    rng = np.random.default_rng(4)
    stems = {"xx": ["banana", "bandana", "nab", "ban", "an"], "yy": ["the", "cat", "sat", "mat", "hat", "then"], "zz": ["ku", "kulo", "luko", "ok"]}
    size = {"xx": 700, "yy": 700, "zz": 2}
    rows = [(1000 * j + i, " ".join(rng.choice(stems[x], 90)), x) for j, x in enumerate(size) for i in range(size[x])]
    schema = "id long, text string, lang string"
    plain = langid.train(spark.createDataFrame(rows, schema))
    assert np.isfinite(plain.limit).all()
    odd = [(i, "the " + "qxz jvk wqz " * 30, x) if i % 100 == 7 and x == "yy" and i < 1200 else (i, text, x) for i, text, x in rows]
    assert 0 < sum(a != b for a, b in zip(odd, rows)) <= 2
    assert np.allclose(langid.train(spark.createDataFrame(odd, schema)).limit[:2], plain.limit[:2], atol=0.1)
    got = langid.identify(spark.createDataFrame([*rows, (9001, "kulo ku ok luko " * 20, None), (9002, "wqz jvk qxz pfft " * 20, None)], schema), id_col="id")
    by = {r.id: r.rejected for r in got.where("id > 9000").collect()}
    assert by == {9001: False, 9002: True}
