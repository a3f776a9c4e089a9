"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own embedding (by hash bucket) beside the scaled sum of its
byte trigrams' embeddings, so unseen spellings of a known stem are still seen.
Windows of ``WINDOW`` words, a new one every ``STRIDE``, cover the whole text; both
directions of the network read a window, attention weighs its words, and the
document's logit is its highest window's.

Training sees at most ``TRAIN_ROWS`` labelled documents of each label, of at most
``TRAIN_BYTES`` bytes, picked by a hash of the id: a bound on what reaches the driver.
The loss is on documents: the windows' logits are pooled by a soft maximum, so a
label needn't hold for every window.  A training takes ``STEPS`` steps whatever the sample.
The score is calibrated (Platt) on logits that ``FOLDS`` networks give to the parts of the sample
which they weren't trained on, and then moved to the label shares of all labelled documents.

Defined results: null and empty texts and texts without words have score 0; without
labels of both kinds all scores are 0; several labels of a document count as toxic if
one is; labels without a document and null labels count for nothing; a null id is
scored, never learnt from, and not held out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.storage import in_batches
from reviewlab.llm.textkernel import ALNUM, Words, mix64, slices

WINDOW, STRIDE = 32, 16
TRAIN_ROWS, TRAIN_BYTES = 1000, 12_000
WORD_BITS, TRIGRAM_BITS = 15, 13
WORD_DIM, TRIGRAM_DIM, HIDDEN, ATTENTION = 12, 8, 8, 8
STEPS, BATCH, RATE, SHARPNESS, FOLDS = 250, 32, 0.01, 1.0, 3


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Distinct:
    """The distinct words of a slice, and which of them stands at each place."""

    bucket: np.ndarray
    trigram: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, buf: np.ndarray, words: Words) -> Distinct:
        _, at, place = np.unique(words.hash, return_index=True, return_inverse=True)
        size = words.end[at] - words.start[at]
        first = np.concatenate([[0], np.cumsum(size)])
        # a word's bytes with one 0 before it; trigrams end at each byte
        lead = np.repeat(np.arange(len(at)), size)
        byte = ALNUM[buf[words.start[at][lead] + np.arange(first[-1]) - first[lead]]]
        inside = np.arange(first[-1]) - first[lead]
        one, two = np.where(inside >= 1, np.roll(byte, 1), 0), np.where(inside >= 2, np.roll(byte, 2), 0)
        code = mix64(byte + one * np.uint64(31) + two * np.uint64(961))
        return cls((words.hash[at] >> np.uint64(64 - WORD_BITS)).astype(np.int64),
                   (code >> np.uint64(64 - TRIGRAM_BITS)).astype(np.int64), first, place)


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, row) of every window of rows whose words are ``first[r]:first[r+1]``."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.ceil(np.maximum(n - WINDOW, 0) / STRIDE).astype(np.int64), 0)
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(row)) - np.concatenate([[0], np.cumsum(count)])[row]
    start = first[row] + nth * STRIDE
    return start, np.minimum(WINDOW, first[row + 1] - start), row


def _gru(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool):
    """States (T, H, N) of one direction over inputs (T, 3H, N); with ``keep`` what its gradient needs."""
    steps, width, n = x.shape
    h = width // 3
    state, out, kept = np.zeros((h, n), x.dtype), np.empty((steps, h, n), x.dtype), []
    for t in range(steps):
        side = u @ state
        gates = _sigmoid(x[t, :2 * h] + side[:2 * h])
        z, r = gates[:h], gates[h:]
        fresh = np.tanh(x[t, 2 * h:] + r * side[2 * h:])
        if keep:
            kept.append((state, z, r, fresh, side[2 * h:]))
        state = state + mask[t] * (1 - z) * (fresh - state)
        out[t] = state
    return out, kept


def _gru_back(grad: np.ndarray, mask: np.ndarray, u: np.ndarray, kept) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a direction's inputs and recurrent weights, from that of its states."""
    steps, h, n = grad.shape
    dx, du, carry = np.empty((steps, 3 * h, n), grad.dtype), np.zeros_like(u), np.zeros((h, n), grad.dtype)
    for t in range(steps - 1, -1, -1):
        before, z, r, fresh, side = kept[t]
        d = grad[t] + carry
        step = d * mask[t]
        dn = step * (1 - z) * (1 - fresh * fresh)
        dx[t, :h] = step * (before - fresh) * z * (1 - z)
        dx[t, h:2 * h] = dn * side * r * (1 - r)
        dx[t, 2 * h:] = dn
        back = np.concatenate([dx[t, :2 * h], dn * r])
        du += back @ before.T
        carry = d - step * (1 - z) + u.T @ back
    return dx, du


class Network:
    """Parameters by name, forward and gradient."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        wide = WORD_DIM + TRIGRAM_DIM

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": np.zeros((1 << WORD_BITS, WORD_DIM), np.float32), "trigram": normal(1 << TRIGRAM_BITS, TRIGRAM_DIM, scale=0.05),
                  "input": normal(6 * HIDDEN, wide, scale=wide ** -0.5), "bias": np.zeros((6 * HIDDEN, 1), np.float32),
                  "ahead": normal(3 * HIDDEN, HIDDEN, scale=HIDDEN ** -0.5), "behind": normal(3 * HIDDEN, HIDDEN, scale=HIDDEN ** -0.5),
                  "attend": normal(ATTENTION, 2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5), "pick": normal(1, ATTENTION, scale=0.5),
                  "out": normal(1, 2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5), "base": np.full((1, 1), -1.0, np.float32)}
        self.slope, self.shift = 1.0, 0.0

    def embed(self, words: Distinct) -> np.ndarray:
        """(distinct words, word and trigram dimensions)"""
        n = np.maximum(1, np.diff(words.first))
        sums = np.add.reduceat(self.p["trigram"][words.trigram], words.first[:-1], axis=0) if len(n) else np.zeros((0, TRIGRAM_DIM), np.float32)
        return np.concatenate([self.p["word"][words.bucket], sums / np.sqrt(n)[:, None].astype(np.float32)], axis=1)

    def forward(self, words: Distinct, start: np.ndarray, length: np.ndarray, keep: bool = False):
        """Logits of windows; with ``keep`` also what ``backward`` needs."""
        p, h = self.p, HIDDEN
        seen = self.embed(words)
        table = p["input"] @ seen.T + p["bias"]
        at = start[None, :] + np.arange(WINDOW)[:, None]
        mask = (np.arange(WINDOW)[:, None] < length[None, :]).astype(np.float32)
        ids = words.place[np.minimum(at, len(words.place) - 1)]
        x = np.empty((WINDOW, 6 * h, len(start)), np.float32)
        for t in range(WINDOW):
            np.take(table, ids[t], axis=1, out=x[t], mode="clip")
        ahead, kept_a = _gru(x[:, :3 * h], mask, p["ahead"], keep)
        behind, kept_b = _gru(x[::-1, 3 * h:], mask[::-1], p["behind"], keep)
        states = np.concatenate([ahead, behind[::-1]], axis=1)
        looked = np.tanh(p["attend"] @ states)
        weight = np.where(mask > 0, (p["pick"] @ looked)[:, 0], -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,thn->hn", weight, states)
        logit = (p["out"] @ pooled + p["base"])[0]
        return logit, (words, seen, ids, mask, kept_a, kept_b, states, looked, weight, pooled) if keep else None

    def backward(self, dlogit: np.ndarray, kept) -> dict[str, np.ndarray]:
        """Gradients of all parameters from that of the windows' logits."""
        words, seen, ids, mask, kept_a, kept_b, states, looked, weight, pooled = kept
        p, h, g = self.p, HIDDEN, {}
        g["out"], g["base"] = dlogit[None] @ pooled.T, dlogit.sum().reshape(1, 1)
        dpooled = p["out"].T @ dlogit[None]
        dstates = weight[:, None] * dpooled[None]
        dweight = np.einsum("thn,hn->tn", states, dpooled)
        dscore = weight * (dweight - (weight * dweight).sum(0))
        g["pick"] = np.einsum("tn,tan->a", dscore, looked)[None]
        dlook = dscore[:, None] * p["pick"].T[None] * (1 - looked * looked)
        g["attend"] = np.einsum("tan,thn->ah", dlook, states)
        dstates += p["attend"].T @ dlook
        dxa, g["ahead"] = _gru_back(dstates[:, :h], mask, p["ahead"], kept_a)
        dxb, g["behind"] = _gru_back(dstates[::-1, h:], mask[::-1], p["behind"], kept_b)
        dx = np.concatenate([dxa, dxb[::-1]], axis=1) * mask[:, None]
        flat, dx = ids.reshape(-1), dx.transpose(0, 2, 1).reshape(-1, 6 * h)
        dtable = np.zeros((len(seen), 6 * h), np.float32)
        np.add.at(dtable, flat, dx)
        g["input"], g["bias"] = dtable.T @ seen, dtable.sum(0)[:, None]
        dseen = dtable @ p["input"]
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], words.bucket, dseen[:, :WORD_DIM])
        n = np.diff(words.first)
        g["trigram"] = np.zeros_like(p["trigram"])
        np.add.at(g["trigram"], words.trigram, np.repeat(dseen[:, WORD_DIM:] / np.sqrt(np.maximum(1, n))[:, None], n, axis=0))
        return g


def _texts(texts: list[str]) -> tuple[np.ndarray, Words]:
    _, _, buf, offsets = next(slices(pa.array(texts, pa.large_string()), 1 << 40))
    return buf, Words(buf, offsets, ALNUM, signs=False)


def _windowed(texts: list[str]):
    buf, words = _texts(texts)
    return Distinct.of(buf, words), *windows_of(words.first)


def document_logits(network: Network, buf: np.ndarray, words: Words) -> np.ndarray:
    """The highest window logit of each row, -inf for rows without words."""
    out = np.full(len(words.first) - 1, -np.inf)
    if len(words.start):
        distinct = Distinct.of(buf, words)
        start, length, row = windows_of(words.first)
        for lo in range(0, len(start), 4096):
            logit, _ = network.forward(distinct, start[lo:lo + 4096], length[lo:lo + 4096])
            np.maximum.at(out, row[lo:lo + 4096], logit)
    return out


def trained(texts: list[str], labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> Network:
    """A network after ``steps`` steps over batches of the texts, in an order of their own each time round."""
    rng = np.random.default_rng(seed)
    learn = rng.permutation(len(texts))
    net = Network(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step = 0
    while step < steps:
        before = step
        for lo in range(0, len(learn), BATCH):
            if step == steps:
                break
            own = learn[lo:lo + BATCH]
            distinct, start, length, row = _windowed([texts[i] for i in own])
            if not len(start):
                continue
            logit, kept = net.forward(distinct, start, length, keep=True)
            # a document's logit is the soft maximum of its windows'
            heads = np.flatnonzero(np.diff(row, prepend=-1))
            top = np.maximum.reduceat(logit, heads)
            each = np.exp(SHARPNESS * (logit - np.repeat(top, np.diff(np.append(heads, len(row))))))
            total = np.add.reduceat(each, heads)
            docs = row[heads]
            z = top + np.log(total) / SHARPNESS
            wrong = (_sigmoid(z) - labels[own][docs]) / len(docs)
            which = np.repeat(np.arange(len(docs)), np.diff(np.append(heads, len(row))))
            grads = net.backward((wrong[which] * each / total[which]).astype(np.float32), kept)
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                net.p[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
        if step == before:
            break  # no text has words
        learn = rng.permutation(learn)
    return net


def fit(texts: list[str], labels: np.ndarray, share: float, steps: int = STEPS, seed: int = 5, folds: int = FOLDS) -> Network:
    """Train on a sample of documents; ``share`` is that of label 1 among all labelled documents."""
    net = trained(texts, labels, steps, seed)
    # parts of equal label shares; each is scored by a network that hasn't seen it
    part = np.empty(len(texts), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        part[np.random.default_rng(seed + label).permutation(own)] = np.arange(len(own)) % folds
    x = np.full(len(texts), -np.inf)
    for f in range(folds):
        seen = [i for i in range(len(texts)) if part[i] != f]
        left = np.flatnonzero(part == f)
        if len(left) and 0 < labels[seen].sum() < len(seen):
            x[left] = document_logits(trained([texts[i] for i in seen], labels[seen], steps, seed), *_texts([texts[i] for i in left]))
    # Platt scaling on these, targets smoothed, then the shift to all labels' share
    x, y = x[np.isfinite(x)], labels[np.isfinite(x)]
    ones, zeros = y.sum(), (1 - y).sum()
    if ones and zeros:
        target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        a, b = 1.0, 0.0
        for _ in range(100):
            q = _sigmoid(a * x + b)
            w = q * (1 - q) + 1e-6
            grad = np.array([((q - target) * x).sum() + 1e-3 * (a - 1), (q - target).sum()])
            hess = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, grad), -1, 1)
        net.slope, net.shift = float(a), float(b)
    sampled = labels.mean()
    net.shift += float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))
    return net


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network | None = shared.value
        for batch in batches:
            for a, b, buf, offsets in slices(batch.column(1)):
                score = np.zeros(b - a)
                if net is not None:
                    logit = document_logits(net, buf, Words(buf, offsets, ALNUM, signs=False))
                    some = np.isfinite(logit)
                    score[some] = _sigmoid(net.slope * logit[some] + net.shift)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score)], names=["id", "score"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_rows: int) -> Network | None:
    """A network from a bounded sample of the labelled rows outside the held-out quarter."""
    known = (labels.where(F.col(label_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2))
             .groupBy(F.col(id_col).alias("own")).agg(F.max(label_col).cast("int").alias("y")))
    known = known.join(docs.select(F.col(id_col).alias("there")), F.col("own") == F.col("there"), "left_semi")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    space = 1 << 30
    bound = F.when(F.col("y") == 1, int(min(1.0, train_rows / counts[1]) * space)).otherwise(int(min(1.0, train_rows / counts[0]) * space))
    sample = known.where(F.pmod(F.xxhash64("own"), F.lit(space)) < bound)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .where(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES))
            .join(F.broadcast(sample), F.col("id") == F.col("own")).select("id", "text", "y").toPandas())
    rows = rows.sort_values(["id", "text"])
    y = rows["y"].to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return None
    return fit(rows["text"].tolist(), y, counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS, threshold: float = 0.3) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    network = train(docs, labels, id_col, text_col, label_col, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = in_batches(docs).select(F.struct(F.col(id_col).alias("id"), held.alias("held_out")).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scorer(shared), f"id {id_type}, score double").select(
        F.col("id.id").alias(id_col), "id.held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
