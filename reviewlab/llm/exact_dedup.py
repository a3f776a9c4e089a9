"""Exact deduplication by progressive refinement, in DataFrame operations only.

Rows are grouped by byte length, those that share a length by a hash of their
first bytes as well, and only rows that still share both have their full
content hashed.  What moves between stages is an id, a length and a hash.

Defined results: a null text counts as empty; rows with an equal id and equal
text are one document, and all of them carry the same decision; a null id loses
against any other and stays only where its whole group has null ids; an empty
table gives an empty table; other columns are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import few, stash

PREFIX_CHARS = 64
#: Ids that may be broadcast to pick out the rows to hash in full: 8 bytes each, so 4 MB.
BROADCAST_IDS = 500_000


def _keys(id_: Column, text: Column, prefix_chars: int) -> list[Column]:
    body = F.coalesce(text, F.lit(""))
    return [id_.alias("id"), F.octet_length(body).alias("n_bytes"),
            F.xxhash64(F.substring(body, 1, prefix_chars)).alias("prefix")]


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _repeated(keys: DataFrame, *by: str) -> DataFrame:
    """Rows whose ``by`` value occurs more than once; counts are summed before they are shuffled."""
    often = keys.groupBy(*by).count().where("count > 1").drop("count")
    return keys.join(often, list(by), "left_semi")


def surviving_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      prefix_chars: int = PREFIX_CHARS, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """(id, n_bytes, prefix, digest) of the rows that share length and prefix hash with another row.

    While the survivors' ids fit the broadcast bound, the second scan hashes only their
    texts; beyond it every text is hashed where it is scanned, since moving texts
    through a shuffle costs more than hashing them, and only digests are shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    keys = stash(rows.select(*_keys(F.col("id"), F.col("body"), prefix_chars)), "dedup-keys")
    live = stash(_repeated(_repeated(keys, "n_bytes"), "n_bytes", "prefix"), "dedup-live")
    few = live.count() <= broadcast_ids
    ids = live.select(F.col("id").alias("live_id")).distinct()
    hit = F.col("id").eqNullSafe(F.col("live_id"))
    hashed = [*_keys(F.col("id"), F.col("body"), prefix_chars), _digest(F.col("body")).alias("digest")]
    if few:
        return rows.join(F.broadcast(ids), hit, "left_semi").select(*hashed)
    return rows.select(*hashed).join(ids, hit, "left_semi")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """(digest, keep_id, group_size) of every group of two or more equal texts."""
    found = surviving_digests(docs, id_col, text_col, **bounds)
    return (found.groupBy("n_bytes", "prefix", "digest")
            .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .where("group_size > 1").select("digest", "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id has too."""
    found = stash(surviving_digests(docs, id_col, text_col, **bounds), "dedup-digests")
    best = found.groupBy("n_bytes", "prefix", "digest").agg(F.max("id").alias("keep_id"))
    lost = (found.join(best, ["n_bytes", "prefix", "digest"])
            .where(~F.col("id").eqNullSafe(F.col("keep_id")))
            .select(F.col("id").alias("lost_id"), F.col("n_bytes").alias("lost_bytes"),
                    F.col("prefix").alias("lost_prefix")).distinct())
    lost = stash(lost, "dedup-lost")
    # an id may repeat with another text, so the text's length and prefix decide too
    _, n_bytes, prefix = _keys(docs[id_col], docs[text_col], bounds.get("prefix_chars", PREFIX_CHARS))
    return docs.join(few(lost), docs[id_col].eqNullSafe(lost["lost_id"]) & (n_bytes == lost["lost_bytes"])
                     & (prefix == lost["lost_prefix"]), "left_anti")


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and the text's SHA-256."""
    groups = exact_groups(docs, id_col, text_col, **bounds)
    every = docs.select(F.col(id_col).alias("own_id"), _digest(F.col(text_col)).alias("digest"))
    keep = F.coalesce("keep_id", "own_id")
    return (every.join(groups, "digest", "left")
            .select(F.col("own_id").alias(id_col), keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("own_id").eqNullSafe(keep).alias("kept"), F.col("digest").alias("text_sha256")))
