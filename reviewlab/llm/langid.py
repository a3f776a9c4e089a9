"""Language identification by interpolated Kneser-Ney character models.

Text is folded to 64 symbols: a-z, one for every run of non-letters, and 37
classes that all other letters are hashed to.  Every 4-gram of every labelled
training document is counted in Spark; a language's model is interpolated
Kneser-Ney over orders 4 to 1.  A 4-gram has 24 bits, so an order holds at most
2**24 entries whatever the corpus: that bounds what is collected and broadcast
(counts: 8 bytes an entry and language; usually some 100,000 entries).

Tables are sorted hash arrays, one row for an n-gram with the log-probabilities
of all languages side by side; an n-gram that some language hasn't seen holds
that language's interpolated value, and one that none has seen backs off.

A document goes to the language of the lowest cross-entropy per symbol.  To
calibrate rejection, models are first made without a fifth of the training
documents (by a hash of the id, whatever their number) and that fifth is scored.
A document is rejected if its excess over its language's mean there, scaled down
for short texts, is more than 1.5 times the ``QUANTILE`` of the excess there and
``MARGIN`` nats.  A language with fewer than ``FEW`` rows there has the mean and the
quantile of all languages' rows, or its own where they are larger; where all have fewer
than ``FEW``, n of them, the margin grows by sqrt(FEW / n).  The final models have all
counts.

Defined results: null texts and texts without a letter are ``und``, score 0,
rejected; without any labelled row all texts are ``und`` and only those without
a letter are rejected; ties go to the language that sorts first; rows with a
null id are scored, never learnt from, and not held out; repeated rows count
each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import in_batches, stash
from reviewlab.llm.textkernel import slices
from reviewlab.llm.workercache import lean

ORDER, BITS = 4, 6
CALIBRATION_SHARE, QUANTILE, FEW = 0.2, 0.99, 100
#: Nats per symbol beyond the calibrated limit that are let pass.
MARGIN = 0.25
#: Symbols beyond which a text's cross-entropy counts as settled.
SETTLED = 400
_ODD = 0x9E3779B1


def _fold(char: str) -> int:
    """0 for anything but a letter, 1 to 26 for a-z, 27 to 63 for other letters."""
    char = char.lower()[0]
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + (ord(char) * 2654435761 >> 7) % 37 if char.isalpha() else 0


_SYMBOLS = np.array([_fold(chr(c)) for c in range(0x10000)], np.uint8)


def symbols(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): the 4-gram that ends at each symbol, and where each row's begin.

    Runs of non-letters are one symbol 0, those before the first letter none; a
    row starts after three 0s, which occur nowhere else.
    """
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    rows = heads[offsets]
    far = points >= 0x10000
    sym = _SYMBOLS[np.where(far, 0, points)]
    for i in np.flatnonzero(far):
        sym[i] = _fold(chr(points[i]))
    before = np.zeros(len(sym), np.uint8)
    before[1:] = sym[:-1]
    before[rows[:-1][rows[:-1] < len(sym)]] = 0
    keep = (sym != 0) | (before != 0)
    first = np.concatenate([[0], np.cumsum(keep)])[rows]
    n_rows = len(rows) - 1
    padded = np.zeros(first[-1] + 3 * n_rows, np.uint32)
    at = np.arange(first[-1]) + 3 * (1 + np.repeat(np.arange(n_rows), np.diff(first)))
    padded[at] = sym[keep]
    codes = padded[at]
    for j in range(1, ORDER):
        codes |= padded[at - j] << np.uint32(BITS * j)
    return codes, first


class HashTable:
    """Distinct n-gram codes as a sorted array of their hashes, with an index over the top bits."""

    def __init__(self, codes: np.ndarray, order: int):
        self.bits = BITS * order
        self.shift = max(0, self.bits - 20)
        hashed = self._hash(codes)
        self.by = np.argsort(hashed)
        self.keys = np.append(hashed[self.by], np.uint32(0xFFFFFFFF))
        self.starts = np.searchsorted(self.keys[:-1], np.arange((1 << (self.bits - self.shift)) + 1, dtype=np.uint64)
                                      << np.uint64(self.shift)).astype(np.int32)

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint32) * np.uint32(_ODD)) & np.uint32((1 << self.bits) - 1)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code in the sorted array, or -1."""
        h = self._hash(codes)
        at = self.starts[h >> np.uint32(self.shift)]
        out = np.where(self.keys[at] == h, at, -1)
        left = np.flatnonzero((out < 0) & (self.keys[at] < h))
        at = at[left]
        while len(left):
            at = at + 1
            key, want = self.keys[at], h[left]
            out[left[key == want]] = at[key == want]
            more = key < want
            left, at = left[more], at[more]
        return out


@dataclass
class Model:
    """Log-probabilities of all languages by order, and the weights that contexts give to the lower order."""

    languages: list[str]
    unigrams: np.ndarray
    tables: dict[int, tuple[HashTable, np.ndarray]]
    contexts: dict[int, tuple[HashTable, np.ndarray]]
    mean: np.ndarray | None = None
    limit: np.ndarray | None = None

    def log_probs(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(codes, languages): log-probability of each n-gram's last symbol."""
        if order == 1:
            return self.unigrams[codes]
        table, values = self.tables[order]
        at = table.find(codes)
        out = values[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            lost = codes[miss]
            low = self.log_probs(lost & np.uint32((1 << BITS * (order - 1)) - 1), order - 1)
            seen, weights = self.contexts[order]
            at = seen.find(lost >> np.uint32(BITS))
            out[miss] = low + np.where((at >= 0)[:, None], weights[at], 0)
        return out

    def cross_entropy(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(rows, languages): nats per symbol; rows without symbols have 0."""
        n = np.diff(first)
        out = np.zeros((len(n), len(self.languages)))
        some = n > 0
        if some.any():
            values = self.log_probs(codes)
            for j in range(values.shape[1]):
                out[some, j] = -np.add.reduceat(values[:, j], first[:-1][some], dtype=np.float64) / n[some]
        return out


def _discount(counts: np.ndarray) -> float:
    ones, twos = (counts == 1).sum(), (counts == 2).sum()
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The interpolated models of ``{language: (4-gram codes, counts)}``."""
    languages = sorted(counts)
    grams: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
    for lang in languages:
        codes, n = (np.asarray(x) for x in counts[lang])
        own = {ORDER: (codes.astype(np.uint32), n.astype(np.float64))}
        for order in range(ORDER - 1, 0, -1):  # below the top a count is that of distinct left neighbours
            suffix, kinds = np.unique(own[order + 1][0] & np.uint32((1 << BITS * order) - 1), return_counts=True)
            own[order] = suffix, kinds.astype(np.float64)
        grams.append(own)
    size = 1 << BITS
    uni = np.empty((size, len(languages)))
    for j, own in enumerate(grams):
        codes, n = own[1]
        d = _discount(n)
        uni[:, j] = d * len(n) / n.sum() / size
        uni[codes, j] += (n - d).clip(0) / n.sum()
    lower = (np.arange(size, dtype=np.uint32), uni)
    tables, contexts = {}, {}
    for order in range(2, ORDER + 1):
        union = np.unique(np.concatenate([own[order][0] for own in grams]))
        heads = np.unique(union >> np.uint32(BITS))
        value = lower[1][np.searchsorted(lower[0], union & np.uint32((1 << BITS * (order - 1)) - 1))].copy()
        weight = np.ones((len(heads), len(languages)))
        for j, own in enumerate(grams):
            codes, n = own[order]
            d = _discount(n)
            head = np.searchsorted(heads, codes >> np.uint32(BITS))
            total = np.bincount(head, n, len(heads))
            taken = np.bincount(head, np.minimum(n, d), len(heads))
            seen = total > 0
            weight[seen, j] = taken[seen] / total[seen]
            value[:, j] *= weight[np.searchsorted(heads, union >> np.uint32(BITS)), j]
            value[np.searchsorted(union, codes), j] += (n - d).clip(0) / total[head]
        table, seen_heads = HashTable(union, order), HashTable(heads, order - 1)
        tables[order] = table, np.log(value)[table.by].astype(np.float32)
        contexts[order] = seen_heads, np.log(weight)[seen_heads.by].astype(np.float32)
        lower = union, value
    return Model(languages, np.log(uni).astype(np.float32), tables, contexts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (lang, part, code, n) of a task's (text, lang, part) rows; merged every few slices."""
    names: dict[tuple[str, int], int] = {}
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    for batch in batches:
        langs = np.array([names.setdefault(x, len(names)) for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], np.uint64)
        for a, b, buf, offsets in slices(batch.column(0)):
            codes, first = symbols(buf, offsets)
            keys = codes | np.repeat(langs[a:b] << np.uint64(32), np.diff(first))
            parts.append(np.unique(keys, return_counts=True))
            if len(parts) >= 32:
                parts = [merged()]
    if parts:
        keys, n = merged()
        of, own = np.array(list(names), object), (keys >> np.uint64(32)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(of[own, 0], pa.string()), pa.array(of[own, 1], pa.int32()),
                                          pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)],
                                         names=["lang", "part", "code", "n"])


def _scorer(shared):
    """Rows (id, text) as (id, lang_pred, score, rejected, entropy, symbols)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(1)):
                codes, first = symbols(buf, offsets)
                n = np.diff(first)
                best = np.full(b - a, len(names) - 1)
                entropy, score, rejected = np.zeros(b - a), np.zeros(b - a), n == 0
                if model.languages:
                    h = model.cross_entropy(codes, first)
                    best = np.where(n > 0, h.argmin(1), best)
                    entropy = h.min(1)
                    score = np.where(n > 0, 1 / np.exp((entropy[:, None] - h) * 0.1 * n[:, None]).sum(1), 0.0)
                    if model.limit is not None:
                        of = best.clip(max=len(model.languages) - 1)
                        excess = (entropy - model.mean[of]) * np.sqrt(np.minimum(n, SETTLED) / SETTLED)
                        rejected = rejected | (excess > model.limit[of])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(names[best], pa.string()), pa.array(score),
                     pa.array(rejected), pa.array(entropy), pa.array(n.astype(np.int64))],
                    names=["id", "lang_pred", "score", "rejected", "entropy", "symbols"])
    return run


def _scores(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["id"].dataType.simpleString()
    return in_batches(rows).select("id", "text").mapInArrow(
        lean(_scorer(shared)), f"id {id_type}, lang_pred string, score double, rejected boolean, entropy double, symbols long")


def train(labelled: DataFrame, calibration_share: float = CALIBRATION_SHARE) -> Model:
    """Models of (id, text, lang) rows: counts over all of them, calibration over a share of them."""
    labelled = labelled.withColumn("part", (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(calibration_share * (1 << 30))).cast("int"))
    counts = stash(in_batches(labelled).select("text", "lang", "part").mapInArrow(lean(_count), "lang string, part int, code long, n long")
                   .groupBy("lang", "part", "code").agg(F.sum("n").alias("n")), "lang-counts").toPandas()
    if not len(counts):
        return Model([], np.zeros((1 << BITS, 0)), {}, {})

    def built(rows) -> Model:
        rows = rows.groupby(["lang", "code"], as_index=False)["n"].sum()
        return kneser_ney({lang: (g["code"].to_numpy(), g["n"].to_numpy()) for lang, g in rows.groupby("lang")})

    model = built(counts)
    own, pooled, margin = {}, (0.0, np.inf), MARGIN
    if (counts["part"] == 0).any():
        scored = stash(_scores(labelled.where("part = 1"), built(counts[counts["part"] == 0])).where("symbols > 0")
                       .select("lang_pred", "entropy", "symbols"), "lang-calibration")
        means = scored.groupBy("lang_pred").agg(F.avg("entropy").alias("mean"))
        excess = (F.col("entropy") - F.col("mean")) * F.sqrt(F.least(F.col("symbols"), F.lit(SETTLED)) / SETTLED)
        most = F.percentile_approx(excess, F.lit(QUANTILE), F.lit(10_000)).alias("most")
        for r in (scored.join(F.broadcast(means), "lang_pred").groupBy("lang_pred")
                  .agg(F.max("mean").alias("mean"), most, F.count(F.lit(1)).alias("n")).collect()):
            own[r.lang_pred] = r.mean, r.most, r.n
        r = scored.crossJoin(F.broadcast(scored.agg(F.avg("entropy").alias("mean")))).agg(F.max("mean").alias("mean"), most, F.count(F.lit(1)).alias("n")).first()
        if r.n:
            pooled, margin = (r["mean"], r["most"]), MARGIN * max(1.0, FEW / r.n) ** 0.5
    both = []
    for x in model.languages:
        mean, most, n = own.get(x, (*pooled, 0))
        both.append((mean, most) if n >= FEW else (max(mean, pooled[0]), max(most, pooled[1])))
    model.mean = np.array([mean for mean, _ in both])
    model.limit = np.array([1.5 * most + margin for _, most in both])
    return model


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                       F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("fp"))


def _trained(rows: DataFrame, calibration_share: float) -> Model:
    return train(rows.where("NOT held_out AND lang IS NOT NULL AND id IS NOT NULL"), calibration_share)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             calibration_share: float = CALIBRATION_SHARE) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, rejected, entropy.

    Learns from the labelled rows whose crc32(id as text) mod 4 isn't 2.
    """
    rows = _rows(docs, id_col, text_col, lang_col)
    model = _trained(rows, calibration_share)
    out = _scores(rows.withColumn("id", F.struct("id", "held_out")), model)
    return out.select(F.col("id.id").alias(id_col), "id.held_out", "lang_pred", "score", "rejected", "entropy")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    calibration_share: float = CALIBRATION_SHARE) -> DataFrame:
    """``docs`` without the documents that no model accepts."""
    rows = _rows(docs, id_col, text_col, lang_col)
    model = _trained(rows, calibration_share)
    lost = _scores(rows.withColumn("id", F.struct("id", "fp")), model).where("rejected")
    lost = stash(lost.select(F.col("id.id").alias("lost_id"), F.col("id.fp").alias("lost_fp")).distinct(), "lang-rejected")
    return docs.join(lost, docs[id_col].eqNullSafe(lost["lost_id"])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == lost["lost_fp"]), "left_anti")
