import string

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import text as tx

SAMPLES = [None, "", "   ", "\t\n", "It&#039;s GOOD!!  Really\tgood\n", "ÄÖÜ ß straße NASA ok", "a,b.c;d",
           "!!!???", "  lead and trail  ", "039039", "ID 42 USA-made", "ǅ title", "x y z"]


def py_clean_review(t):
    if t is None:
        return None
    t = t.lower().replace("039", "'")
    t = " ".join(t.split())
    for ch in string.punctuation + "\n\t":
        t = t.replace(ch, "")
    return t


def py_clean_text(t):
    if t is None:
        return None
    t = t.lower()
    for ch in string.punctuation + "\n\t":
        t = t.replace(ch, "")
    return t


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "id int, t string")


def test_clean_review_matches_python(df):
    got = {r["id"]: r["c"] for r in df.select("id", tx.clean_review(F.col("t")).alias("c")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == py_clean_review(s), (s, got[i])


def test_clean_text_matches_python(df):
    got = {r["id"]: r["c"] for r in df.select("id", tx.clean_text(F.col("t")).alias("c")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == py_clean_text(s)


def test_word_and_upper_counts(df):
    rows = df.select("id", tx.word_count("t").alias("w"), tx.upper_word_count("t").alias("u")).collect()
    for r in rows:
        s = SAMPLES[r["id"]]
        assert r["w"] == len(str(s).split())
        expect_u = 0 if s is None else len([w for w in s.split() if w.isupper()])
        assert r["u"] == expect_u, (s, r["u"], expect_u)


def test_marker_null(spark):
    from reviewlab.operators.clean import null_marker
    d = spark.createDataFrame([(1, "acne"), (2, "3 users found this comment helpful."), (3, None)],
                              "id int, condition string")
    got = {r["id"]: r["condition"] for r in null_marker(d).collect()}
    assert got == {1: "acne", 2: None, 3: None}


def test_text_functions_property(spark):
    """Random mixes of letters, punctuation, Unicode, '039' and every kind of
    Python whitespace, checked in one DataFrame against Python semantics."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("aAzZéÉßñ0397 \t\n\x0b\x0c\r\x1c\x85\xa0 　"
                                    + string.punctuation))
    texts = []

    @settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(alphabet, max_size=30).map("".join))
    def collect(t):
        texts.append(t)

    collect()
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = d.select("id", tx.clean_review(F.col("t")).alias("c"), tx.word_count("t").alias("w")).collect()
    for r in rows:
        t = texts[r["id"]]
        assert r["c"] == py_clean_review(t), repr(t)
        assert r["w"] == len(t.split()), repr(t)
