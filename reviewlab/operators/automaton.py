"""Many literal patterns found in one walk over each text (JN-3, ASC-5).

Patterns go into an Aho-Corasick automaton, and a text is walked once whatever their number; the
characters beside a hit are looked at only where there is one.  Patterns are taken in chunks of bounded
size, each an automaton built once a worker and walked in a pass of its own, so neither the driver nor a
task ever holds more than a chunk of a large dimension.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.indexing import ordered_index

#: Characters of patterns in one automaton.
CHUNK_CHARS = 4 << 20
#: What may not stand before a hit, and what not after it.
BEFORE, AFTER = frozenset("abcdefghijklmnopqrstuvwxyz"), frozenset("abcdefghijklmnopqrstuvwxyz|")
_EMPTY = re.compile(r"[^a-z][^a-z|]")

_built: dict[int, object] = {}


def _automaton(patterns: list[tuple[str, int]], key: int):
    """The automaton of (pattern, rank) pairs, kept while the same ones are asked for."""
    if key not in _built:
        import ahocorasick
        made = ahocorasick.Automaton()
        for word, rank in patterns:
            if word:
                made.add_word(word, (rank, len(word)))
        made.make_automaton()
        _built.clear()
        _built[key] = made
    return _built[key]


def last_hit(text: str, automaton, empty: int | None) -> int | None:
    """The highest rank of the patterns that stand between allowed characters."""
    best = empty if empty is not None and _EMPTY.search(text) else None
    if len(automaton):
        end = len(text) - 1
        for at, (rank, size) in automaton.iter(text):
            if best is not None and rank <= best:
                continue
            start = at - size
            if start >= 0 and at < end and text[start] not in BEFORE and text[at + 1] not in AFTER:
                best = rank
    return best


def last_patterns(rows: DataFrame, patterns: DataFrame, id_col: str, text: str, pattern: str, rank: str) -> DataFrame:
    """(``id_col``, ``pattern``, ``rank``): of the patterns that occur in a row's text between characters outside a-z
    (and outside ``|`` behind it), that of the highest rank; rows without any have no row.  Patterns have distinct ranks."""
    spark = rows.sparkSession
    sized = patterns.select(F.col(pattern).alias("_p"), F.col(rank).alias("_r"), F.length(pattern).alias("_n"))
    whole = sized.agg(F.sum("_n").alias("n"), F.max("_n").alias("top"), F.count("*").alias("rows")).first()
    kind = rows.schema[id_col].dataType.simpleString()
    out_schema = f"{id_col} {kind}, {pattern} string, {rank} bigint"
    if not whole["rows"]:
        return spark.createDataFrame([], out_schema)
    chunks = -(-(whole["n"] + whole["rows"]) // CHUNK_CHARS)
    if chunks > 1:
        # equal numbers of patterns, so few long ones can make a chunk larger by the longest of them
        sized = ordered_index(sized, ["_r"], out="_i").withColumn("_chunk", F.floor(F.col("_i") * chunks / whole["rows"]).cast("int"))
    found = None
    for c in range(chunks):
        part = [(r["_p"], int(r["_r"])) for r in (sized.where(F.col("_chunk") == c) if chunks > 1 else sized).select("_p", "_r").collect()]
        hits = rows.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(_walk(part), f"id {kind}, p string, r bigint")
        found = hits if found is None else found.unionByName(hits)
    if chunks > 1:
        found = found.groupBy("id").agg(F.max(F.struct("r", "p")).alias("x")).select("id", "x.p", "x.r")
    return found.select(F.col("id").alias(id_col), F.col("p").alias(pattern), F.col("r").alias(rank))


def _walk(patterns: list[tuple[str, int]]):
    names = {rank: word for word, rank in patterns}
    empty = next((rank for word, rank in patterns if not word), None)
    key = hash(tuple(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(patterns, key)
        for batch in batches:
            ids, hits = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                hit = None if text is None else last_hit(text, automaton, empty)
                if hit is not None:
                    ids.append(i)
                    hits.append(hit)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array([names[h] for h in hits], pa.string()),
                                              pa.array(hits, pa.int64())], names=["id", "p", "r"])
    return run
