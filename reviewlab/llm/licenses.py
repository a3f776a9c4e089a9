"""Licence scans by diagonal voting, in DataFrame operations only.

Templates are word sequences: phrases, which count where their words stand one after
the other, and notices, which may be a little changed.  Every text's rolling word
k-grams are exploded and joined to the templates' k-grams by hash, their words
compared too.  A match at word p of a text and word t of a template votes for the
diagonal p - t, the place where the template would start.  A phrase stands where its
diagonal has all its votes.  For notices, diagonals at most ``GAP`` apart are merged
(words put in or left out shift the rest), and a merged span with votes for ``COVER`` of the
template's k-grams is verified: its matches are aligned with the template in order, a match following
another only if it stands later in both and no more than ``GAP`` words were put in between.
The span counts if ``COVER`` of the template's k-grams lie on one such alignment, so
shuffled, reversed or scattered words of a notice aren't one.

Only the template table, whose size is fixed by its texts, is broadcast.

Defined results: null and empty texts have no words and no labels, score 0; rows with
an equal id and text are scanned once and share their result; nothing is read but id
and text; very long texts are one row of at most as many votes as words; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.storage import stash

K, GAP, COVER = 2, 3, 0.85
#: Fixed value: what stands between words, once A-Z are lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Notices of public licences, as words, and their labels.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution", "cc-by"),
]


def words(text: Column) -> Column:
    """The words of a text, lower-cased.

    ``lower`` also lowers letters beyond A-Z, which neither parts nor joins words; only
    the Kelvin sign would become a letter that templates may hold, and is left out.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")))
    return F.array_remove(F.split(plain, GAPS), "")


def _grams(of: str) -> Column:
    """Of an array of words, structs of k words in a row (with nulls at the last k - 1 places)."""
    return F.arrays_zip(*(F.slice(of, 1 + j, 1 << 30).alias(f"w{j}") for j in range(K)))


def _exploded(rows: DataFrame, of: str, at: str, *keep: str) -> DataFrame:
    """One row a k-gram: its place, its words, and its hash."""
    grams = rows.select(*keep, F.posexplode(_grams(of)).alias(at, "_g"))
    parts = [F.col("_g")[f"w{j}"].alias(f"w{j}") for j in range(K)]
    return grams.select(*keep, at, *parts).where(f"w{K - 1} IS NOT NULL").withColumn("hash", F.xxhash64(*(f"w{j}" for j in range(K))))


def templates(spark, phrases=None, notices=None) -> DataFrame:
    """(template, label, phrase, size): one row a template; ``size`` is its number of k-grams."""
    rows = [(t, label, True) for t, label in phrases or PHRASES] + [(t, label, False) for t, label in notices or NOTICES]
    quoted = [f"({i}, '{t}', '{label}', {str(phrase).lower()})" for i, (t, label, phrase) in enumerate(rows)]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(quoted)} AS t(template, body, label, phrase)").withColumn(
        "size", F.size(words(F.col("body"))) - (K - 1))


def _aligned(matches: str, size: str) -> Column:
    """The largest number of matches (p in the text, -t in the template) that follow each other in both.

    Matches are taken by text place, later template places first, so one place follows itself never.  For each
    template place the last alignment that ends there is kept: its length and its place in the text.
    """
    none = F.struct(F.lit(0).alias("n"), F.lit(-(1 << 30)).alias("p"))

    def step(acc: Column, m: Column) -> Column:
        cells, t, p = acc["cells"], -m["back"], m["p"]
        before = F.transform(F.slice(cells, F.lit(1), t), lambda q, j: F.when(
            (q["n"] > 0) & (q["p"] < p) & ((p - q["p"]) - (t - j) <= GAP), q["n"]).otherwise(0))
        n = F.coalesce(F.array_max(before), F.lit(0)) + 1
        now = F.struct(n.cast("int").alias("n"), p.cast("int").alias("p"))
        # a shorter alignment takes the place of a longer one only out of whose reach it is
        held = F.transform(cells, lambda q, i: F.when((i == t) & ((n >= q["n"]) | (p - q["p"] > GAP)), now).otherwise(q))
        return F.struct(F.greatest(acc["best"], n.cast("int")).alias("best"), held.alias("cells"))

    start = F.struct(F.lit(0).alias("best"), F.array_repeat(none, F.col(size)).alias("cells"))
    return F.aggregate(F.array_sort(matches), start, step, lambda acc: acc["best"])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sets) -> DataFrame:
    """(doc, template, label, phrase, start, cover): where templates stand; doc is the id and a hash of the text."""
    known = templates(docs.sparkSession, **sets)
    wanted = _exploded(known.withColumn("words", words(F.col("body"))), "words", "at", "template", "size", "phrase")
    wanted = wanted.withColumnsRenamed({f"w{j}": f"t{j}" for j in range(K)})
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("fp"))
    rolled = _exploded(docs.select(doc.alias("doc"), words(F.col(text_col)).alias("words")), "words", "pos", "doc")
    # two words are equal if each starts with the other: said so, it is checked after the
    # lookup by hash and doesn't make the words a part of the join key
    same = " AND ".join(f"startswith(w{j}, t{j}) AND startswith(t{j}, w{j})" for j in range(K))
    votes = (rolled.join(F.broadcast(wanted), "hash").where(same)
             .groupBy("doc", "template", "size", "phrase", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.collect_set("at").alias("at")))
    votes = stash(votes, "licence-votes")
    exact = votes.where("phrase AND size(at) = size").select("doc", "template", F.col("diagonal").alias("start"), F.lit(1.0).alias("cover"))
    matches = F.flatten(F.collect_list(F.transform("at", lambda t: F.struct((F.col("diagonal") + t).cast("int").alias("p"), (-t).cast("int").alias("back")))))
    by = Window.partitionBy("doc", "template").orderBy("diagonal")
    fuzzy = (votes.where("NOT phrase")
             .withColumn("opens", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(by), F.lit(-1 << 30)) > GAP).cast("int"))
             .withColumn("island", F.sum("opens").over(by))
             .groupBy("doc", "template", "size", "island")
             .agg(F.min("diagonal").alias("start"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n"), matches.alias("matches"))
             .where(F.col("n") >= COVER * F.col("size"))
             .select("doc", "template", "start", (_aligned("matches", "size") / F.col("size")).alias("cover")).where(F.col("cover") >= COVER))
    return exact.unionByName(fuzzy).join(F.broadcast(known.select("template", "label", "phrase")), "template")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sets) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    start = F.when(F.col("phrase"), F.col("start"))
    found = spans(docs, id_col, text_col, **sets).groupBy("doc").agg(
        F.count(start).alias("n_base"), F.min(start).cast("long").alias("first_word"), F.max(start).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("cover").alias("score"))
    found = found.select(F.col("doc.id").alias("own_id"), F.col("doc.fp").alias("own_fp"), *found.columns[1:])
    every = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("fp"),
                        F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.lit("")
    return every.join(found, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("fp") == F.col("own_fp")), "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
