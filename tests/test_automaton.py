"""The automaton against regular expressions."""

import re

import numpy as np
import pytest

from reviewlab.operators import automaton
from reviewlab.operators.clean import match_conditions


def brute(texts, conds):
    out = {}
    for i, t in texts:
        for rank, c in sorted((r, c) for c, r in conds):
            if t is not None and re.search("[^a-z]" + re.escape(c) + "[^a-z|s]", t):
                out[i] = c
    return out


@pytest.mark.parametrize("chunk", [4 << 20, 40])
def test_same_rows_as_the_expression(spark, monkeypatch, chunk):
    monkeypatch.setattr(automaton, "CHUNK_CHARS", chunk)
    rng = np.random.default_rng(6)
    letters = list("ab AB.|s\n-é")
    conds = sorted({"".join(rng.choice(letters, rng.integers(1, 5))) for _ in range(60)} | {"", "A", "a", "a b", "Aé.", ".*", "B|"})
    conds = [(c, i * 3) for i, c in enumerate(rng.permutation(conds).tolist())]
    texts = [(i, "".join(rng.choice(letters, rng.integers(0, 30)))) for i in range(200)] + [(900, None), (901, "A"), (902, " A "), (903, "xA "), (904, " A|")]
    rows = spark.createDataFrame(texts, "id long, review string")
    known = spark.createDataFrame(conds, "condition string, first_id long")
    got = {r.id: r.condition for r in match_conditions(rows, known).collect()}
    assert got == brute(texts, conds)


def test_no_conditions(spark):
    rows = spark.createDataFrame([(1, " A ")], "id long, review string")
    assert match_conditions(rows, spark.createDataFrame([], "condition string, first_id long")).collect() == []
