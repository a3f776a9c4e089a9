"""The network's gradient against differences, windows, and held-out scores."""

import numpy as np

from reviewlab.llm import toxicity
from reviewlab.llm.textkernel import ALNUM, Words, slices
from tests.llm.conftest import frame


def test_windows_cover_every_word():
    n = np.array([0, 1, 31, 32, 33, 56, 57, 500])
    first = np.concatenate([[0], np.cumsum(n)])
    start, length, row = toxicity.windows_of(first)
    for r in range(len(n)):
        seen = set()
        for s, k in zip(start[row == r], length[row == r]):
            assert 0 < k <= toxicity.WINDOW and s >= first[r] and s + k <= first[r + 1]
            seen |= set(range(s, s + k))
        assert seen == set(range(first[r], first[r + 1]))


def test_gradient_matches_differences():
    net = toxicity.Network()
    rng = np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["word"] += rng.standard_normal(net.p["word"].shape) * 0.1
    words, start, length, _ = toxicity._windowed(["some words that " * 15, "one two three", "é"])
    logit, kept = net.forward(words, start, length, keep=True)
    weight = rng.standard_normal(len(logit))
    for name, grad in net.backward(weight, kept).items():
        i = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, side = net.p[name][i], []
        for step in (1e-2, -1e-2):
            net.p[name][i] = old + step
            side.append(net.forward(words, start, length)[0] @ weight)
        net.p[name][i] = old
        assert abs(grad[i] - (side[0] - side[1]) / 2e-2) < 2e-3 * max(1, abs(grad[i])), name


def test_a_slice_scores_each_text_as_alone():
    net = toxicity.Network()
    texts = ["alpha beta gamma " * 40, "", "one", None, "x y z " * 11]
    import pyarrow as pa
    _, _, buf, offsets = next(slices(pa.array(texts)))
    together = toxicity.document_logits(net, buf, Words(buf, offsets, ALNUM, signs=False))
    for text, value in zip(texts, together):
        if text:
            assert abs(toxicity.document_logits(net, *toxicity._texts([text]))[0] - value) < 1e-5
        else:
            assert value == -np.inf


def corpus(n):
    """Harmless words, and in every fourth text a stem with varying endings somewhere."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        w = [f"w{j}" for j in rng.integers(0, 300, rng.integers(5, 150))]
        if i % 4 == 0:
            w[rng.integers(0, len(w))] = "vilestem" + "".join(rng.choice(list("aeinrst"), 3))
        rows.append((i, " ".join(w)))
    return rows


def test_held_out_texts_and_edges(spark):
    rows = corpus(800)
    docs = frame(spark, rows + [(5000, None), (5001, ""), (5002, "... !"), (None, "vilestemaei w1"), (5003, "w1 w2 " * 30000 + "vilestemrst")],
                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(800)] + [(0, 1, 1), (9999, 1, 0), (None, 1, 0), (3, None, 0)],
                                   "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == 805 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [r for i, r in got.items() if r.held_out and i is not None and i < 800]
    assert len(held) > 100 and np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.93
    assert [got[i].score for i in (5000, 5001, 5002)] == [0, 0, 0] and got[5003].predicted == 1
    none = toxicity.score(docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(docs.limit(0), labels).collect() == []


def test_labels_without_a_document_change_nothing(spark):
    rows = corpus(160)
    docs = frame(spark, rows)
    labels = [(i, int(i % 4 == 0)) for i in range(160)]
    more = labels + [(10_000 + i, 1) for i in range(4000)]
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, more))
    assert a == b and 0.1 < np.mean(list(a.values())) < 0.5


def test_few_labels_still_find_the_held_out():
    """Some thirty labelled toxic texts; the network takes as many steps as with many."""
    rows = corpus(400)
    texts, y = [t for _, t in rows], np.array([i % 4 == 0 for i, _ in rows], float)
    for n in (130, 300):
        net = toxicity.fit(texts[:n], y[:n], 0.25)
        logit = toxicity.document_logits(net, *toxicity._texts(texts[300:]))
        score = toxicity._sigmoid(net.slope * logit + net.shift)
        assert (score[y[300:] == 1] >= 0.3).mean() >= 0.7 and (score[y[300:] == 0] >= 0.3).mean() <= 0.2
