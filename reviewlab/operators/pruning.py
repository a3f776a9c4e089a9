"""Weakest-link pruning of a fitted tree in linear memory (CLS-3).

A tree is a few arrays over its nodes.  Each inner node's link strength is what collapsing it
costs for each leaf that it saves.  A heap yields the weakest; collapsing it changes the strengths of its
ancestors only, at most MLlib's depth limit of them.  What is kept is one number a node, the alpha at
which it collapses, and not the set of pruned nodes of every step.  The rows of each leaf and label are
counted once, and the number of right answers is carried along the same steps.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession

from reviewlab.session import ensure_checkpoint_dir


@dataclass
class Tree:
    """Children (-1 for leaves) and training rows by class of each node; node 0 is the root."""
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray

    def __post_init__(self):
        n = len(self.left)
        self.parent = np.full(n, -1)
        inner = np.flatnonzero(self.left >= 0)
        self.parent[self.left[inner]] = inner
        self.parent[self.right[inner]] = inner
        #: parents before children, left before right
        self.order = np.empty(n, np.int64)
        stack, at = [0], 0
        while stack:
            i = stack.pop()
            self.order[at] = i
            at += 1
            if self.left[i] >= 0:
                stack += [int(self.right[i]), int(self.left[i])]

    @property
    def leaves(self) -> np.ndarray:
        """Leaves in pre-order: the k-th is the leaf that MLlib's ``leafCol`` calls k."""
        return self.order[self.left[self.order] < 0]

    def cost(self, kind: str) -> np.ndarray:
        """Impurity times the share of rows, of each node as a leaf."""
        n = self.counts.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(n[:, None] > 0, self.counts / n[:, None], 0.0)
            each = 1 - (p * p).sum(axis=1) if kind == "gini" else -np.where(p > 0, p * np.log2(p), 0.0).sum(axis=1)
        return np.where(n > 0, each * n / n[0], 0.0)

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums of the leaves' ``values`` under each node (a leaf's own for itself)."""
        out = np.where(self.left < 0, values, 0).astype(np.asarray(values).dtype)
        for i in self.order[::-1]:
            if self.parent[i] >= 0:
                out[self.parent[i]] += out[i]
        return out


def saved_tree(model, spark: SparkSession) -> Tree:
    """A fitted MLlib tree, read from its saved data."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/tree-{uuid.uuid4().hex}"
    model.write().overwrite().save(base)
    nodes = spark.read.parquet(base + "/data").select("id", "leftChild", "rightChild", "impurityStats").toPandas().sort_values("id")
    return Tree(nodes["leftChild"].to_numpy(), nodes["rightChild"].to_numpy(), np.array(nodes["impurityStats"].tolist(), float))


def weakest_links(tree: Tree, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(alphas, nodes): what collapses, in order; alphas don't fall.  Of equal strengths the first in pre-order goes first."""
    cost = tree.cost(kind)
    inside, leaves = tree.below(cost), tree.below(np.where(tree.left < 0, 1, 0))
    rank = np.empty(len(tree.left), np.int64)
    rank[tree.order] = np.arange(len(tree.left))
    strength = lambda i: (float(cost[i] - inside[i]) / (leaves[i] - 1), int(rank[i]), int(i), int(leaves[i]))
    heap = [strength(i) for i in np.flatnonzero(tree.left >= 0)]
    heapq.heapify(heap)
    gone = np.zeros(len(tree.left), bool)
    alphas, nodes, last = [], [], 0.0
    while heap:
        alpha, _, i, was = heapq.heappop(heap)
        if gone[i] or leaves[i] != was:
            continue  # inside a collapsed node, or queued before a change below it
        last = max(last, alpha)
        alphas.append(last)
        nodes.append(i)
        saved, change = leaves[i] - 1, cost[i] - inside[i]
        stack = [i]
        while stack:  # each node goes once
            j = stack.pop()
            if not gone[j]:
                gone[j] = True
                if tree.left[j] >= 0:
                    stack += [int(tree.left[j]), int(tree.right[j])]
        up = tree.parent[i]
        while up >= 0:
            leaves[up] -= saved
            inside[up] += change
            heapq.heappush(heap, strength(up))
            up = tree.parent[up]
    return np.array(alphas), np.array(nodes, np.int64)


def right_answers(tree: Tree, links: tuple[np.ndarray, np.ndarray], seen: np.ndarray) -> np.ndarray:
    """Right answers of the whole tree and after each collapse, for rows ``seen`` by (node, class) at the leaves."""
    total = np.stack([tree.below(seen[:, c]) for c in range(seen.shape[1])], axis=1)
    own = total[np.arange(len(total)), tree.counts.argmax(axis=1)]
    now = tree.below(np.where(tree.left < 0, own, 0))
    out = [now[0]]
    for i in links[1]:
        change = own[i] - now[i]
        while i >= 0:
            now[i] += change
            i = tree.parent[i]
        out.append(now[0])
    return np.array(out)


def answers_at(tree: Tree, links: tuple[np.ndarray, np.ndarray], alphas) -> np.ndarray:
    """For each alpha the number of collapses that it makes."""
    return np.searchsorted(links[0], np.asarray(alphas, float) + 1e-15, "right")


def leaf_answers(tree: Tree, links: tuple[np.ndarray, np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(class, share of class 1) for each leaf in pre-order, after ``steps`` collapses."""
    cut = np.zeros(len(tree.left), bool)
    cut[links[1][:steps]] = True
    stands = np.arange(len(tree.left))  # the node that answers for each node
    for i in tree.order[1:]:
        up = tree.parent[i]
        if cut[up] or stands[up] != up:
            stands[i] = stands[up]
    c = tree.counts[stands[tree.leaves]]
    n = c.sum(axis=1)
    share = np.divide(c[:, 1], n, out=np.zeros(len(c)), where=n > 0) if c.shape[1] > 1 else np.zeros(len(c))
    return c.argmax(axis=1), share
