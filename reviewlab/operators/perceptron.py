"""A small neural network trained by synchronous mini-batch Adam (CLS-9, CLS-10).

Inputs are standardised on the training rows.  Rows belong to a fixed batch by the md5 of their id and
are written once, a folder a batch.  In each step every task adds up its rows' gradient in numpy, the tasks'
gradients meet in a tree of sums, and the driver, which holds the weights (their number depends on the
layers only) and both of Adam's moments over all epochs, moves the weights.  Nothing of the rows' number reaches
the driver.  With more rows a batch grows and the number of steps stays.

After each epoch the accuracy on the held-out tail is measured.  As batches and first weights are
fixed, training again for the best number of epochs would repeat the same steps, so the weights of
the best epoch (the first of equals) are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.metric import as_vector, matrix
from reviewlab.operators.regress import complete
from reviewlab.operators.features import standardize
from reviewlab.operators.sampling import holdout_tail
from reviewlab.session import stash

#: Steps of an epoch: a batch has this share of the rows.
STEPS = 8
#: Fixed values of Adam.
RATE, BETA1, BETA2, TINY = 1e-3, 0.9, 0.999, 1e-7


class Network:
    """Dense layers with rectified units and one sigmoid output; all weights in one vector."""

    def __init__(self, sizes: list[int]):
        self.sizes = sizes
        self.shapes = [(a, b) for a, b in zip(sizes[:-1], sizes[1:])]
        self.count = sum(a * b + b for a, b in self.shapes)

    def first(self, seed: int) -> np.ndarray:
        """Uniform weights within sqrt(6 / (inputs + outputs)), biases 0."""
        rng = np.random.default_rng(seed)
        return np.concatenate([np.concatenate([rng.uniform(-1, 1, a * b) * np.sqrt(6 / (a + b)), np.zeros(b)]) for a, b in self.shapes])

    def layers(self, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = 0
        for a, b in self.shapes:
            yield weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]
            at += a * b + b

    def forward(self, weights: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Every layer's output; the last is the log odds."""
        out = [x]
        layers = list(self.layers(weights))
        for i, (w, b) in enumerate(layers):
            z = out[-1] @ w + b
            out.append(np.maximum(z, 0) if i < len(layers) - 1 else z)
        return out

    def probability(self, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(weights, x)[-1][:, 0], -500, 500)))

    def loss(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
        """Sum of the cross-entropy."""
        z = self.forward(weights, x)[-1][:, 0]
        return float((np.logaddexp(0, z) - y * z).sum())

    def gradient(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient of the loss's sum over rows."""
        outs = self.forward(weights, x)
        back = (1 / (1 + np.exp(-np.clip(outs[-1], -500, 500)))) - y[:, None]
        parts = []
        for (w, _), inside in zip(reversed(list(self.layers(weights))), reversed(outs[:-1])):
            parts.append(np.concatenate([(inside.T @ back).ravel(), back.sum(axis=0)]))
            back = (back @ w.T) * (inside > 0)
        return np.concatenate(parts[::-1])


class Adam:
    """Both moments of the gradient, kept over all steps."""

    def __init__(self, n: int):
        self.m, self.v, self.t = np.zeros(n), np.zeros(n), 0

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = BETA1 * self.m + (1 - BETA1) * gradient
        self.v = BETA2 * self.v + (1 - BETA2) * gradient * gradient
        rate = RATE * np.sqrt(1 - BETA2**self.t) / (1 - BETA1**self.t)
        return weights - rate * self.m / (np.sqrt(self.v) + TINY)


def gradient_sum(rows: DataFrame, net: Network, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """(mean gradient, rows) of (x, y) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(net.count), 0
        for batch in batches:
            if len(batch):
                total += net.gradient(weights, matrix(batch.column("x")), batch.column("y").to_numpy())
                n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array([np.append(total, n).tobytes()], pa.binary())], names=["g"])

    sums = rows.select("x", "y").mapInArrow(run, "g binary").rdd.map(lambda r: np.frombuffer(r.g)).treeReduce(np.add)
    return sums[:-1] / max(1.0, sums[-1]), int(sums[-1])


def scored(rows: DataFrame, net: Network, weights: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """(*keep, prediction, probability) of rows with x."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = net.probability(weights, matrix(batch.column("x"))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array((p >= 0.5).astype(np.int32)), pa.array(p)],
                                             names=[*keep, "prediction", "probability"])
    return rows.select(*keep, "x").mapInArrow(run, f"{kinds}, prediction int, probability double")


def mlp(train: DataFrame, test: DataFrame, features, label: str = "label", id_col: str = "id", hidden=(64, 32),
        epochs: int = 30, val_frac: float = 0.2, seed: int = 2002, steps: int = STEPS):
    """CLS-9 + CLS-10: (scored test rows, [(epoch, validation accuracy)]).  Rows with a null feature or label aren't trained on;
    test rows with a null feature have no score and are left out."""
    feats = list(features)
    train, test = complete(train, [*feats, label]), complete(test, feats)
    ready = lambda d: standardize(d, feats, ddof=0, fit_on=train).select(
        F.col(id_col).alias("id"), F.col(label).cast("double").alias("y"), as_vector(feats).alias("x"))
    flags = holdout_tail(train.select(id_col), val_frac, id_col).select(F.col(id_col).alias("id"), "is_validation")
    batch = F.pmod(F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(steps)).cast("int")
    rows = stash(ready(train).join(flags, "id").withColumn("batch", batch).repartition("batch").sortWithinPartitions("batch", "id"), "network-rows")
    fitted, held = rows.where("is_validation = 0"), rows.where("is_validation = 1")
    net = Network([len(feats), *hidden, 1])
    weights, adam = net.first(seed), Adam(net.count)
    curve, best = [], None
    for epoch in range(1, epochs + 1):
        for b in range(steps):
            g, n = gradient_sum(fitted.where(F.col("batch") == b), net, weights)
            if n:
                weights = adam.step(weights, g)
        right = scored(held, net, weights, ("y",)).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
        curve.append((epoch, float(right or 0.0)))
        if best is None or curve[-1][1] > best[0]:
            best = curve[-1][1], weights
    out = scored(ready(test), net, best[1], ("id", "y"))
    return out.select(F.col("id").alias(id_col), F.col("y").cast("int").alias("label"), "prediction", "probability"), curve
