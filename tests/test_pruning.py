"""Weakest-link pruning against all subtrees, and on a large tree."""

import itertools
import tracemalloc

import numpy as np
import pytest

from reviewlab.operators.pruning import Tree, answers_at, leaf_answers, right_answers, weakest_links


def grown(rng, leaves, deep=False):
    """A random tree with random rows by class at its leaves."""
    left, right, ends = [-1], [-1], [0]
    while len(ends) < leaves:
        i = ends.pop(rng.integers(max(0, len(ends) - 2), len(ends)) if deep else rng.integers(len(ends)))
        left[i], right[i] = len(left), len(left) + 1
        left += [-1, -1]
        right += [-1, -1]
        ends += [left[i], right[i]]
    counts = np.zeros((len(left), 2))
    counts[ends] = rng.integers(0, 9, (len(ends), 2)) + np.eye(2)[rng.integers(0, 2, len(ends))]
    tree = Tree(np.array(left), np.array(right), counts)
    for c in range(2):
        counts[:, c] = tree.below(counts[:, c])
    return Tree(np.array(left), np.array(right), counts)


def all_subtrees(tree, cost):
    """(cost, leaves, frozenset of leaves) of every pruned tree."""
    def of(i):
        out = [(cost[i], 1, frozenset([i]))]
        if tree.left[i] >= 0:
            out += [(a + c, b + d, x | y) for (a, b, x), (c, d, y) in itertools.product(of(tree.left[i]), of(tree.right[i]))]
        return out
    return of(0)


@pytest.mark.parametrize("kind", ["gini", "entropy"])
@pytest.mark.parametrize("seed", range(6))
def test_every_alpha_gives_the_cheapest_smallest_subtree(kind, seed):
    rng = np.random.default_rng(seed)
    tree = grown(rng, 8)
    cost, links = tree.cost(kind), weakest_links(tree, kind)
    every = all_subtrees(tree, cost)
    assert (np.diff(links[0]) >= 0).all()
    for alpha in [0.0, *((links[0][1:] + links[0][:-1]) / 2), links[0][-1] + 0.01]:
        steps = int(np.searchsorted(links[0], alpha, "right"))
        best = min(c + alpha * n for c, n, _ in every)
        leaves = min((n, sorted(x)) for c, n, x in every if c + alpha * n <= best + 1e-12)[1]
        cut = set(links[1][:steps].tolist())
        stands = set()
        for i in tree.leaves:
            path = [i]
            while tree.parent[path[-1]] >= 0:
                path.append(tree.parent[path[-1]])
            stands.add(next((int(j) for j in path[::-1] if j in cut), int(i)))
        assert cost[list(stands)].sum() + alpha * len(stands) <= best + 1e-9
        assert len(stands) == len(leaves)
        answer, share = leaf_answers(tree, links, steps)
        seen = np.zeros(tree.counts.shape)
        seen[tree.leaves] = rng.integers(0, 5, (len(tree.leaves), 2))
        right = right_answers(tree, links, seen)[answers_at(tree, links, [alpha])[0]]
        assert right == seen[tree.leaves][np.arange(len(answer)), answer].sum()
        assert ((share >= 0) & (share <= 1)).all()


def test_a_hundred_thousand_leaves_in_linear_memory():
    rng = np.random.default_rng(1)
    tree = grown(rng, 100_000)
    tracemalloc.start()
    links = weakest_links(tree, "gini")
    right = right_answers(tree, links, np.where((tree.left < 0)[:, None], 1.0, 0.0) * np.ones((1, 2)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links[1][-1] == 0 and len(right) == len(links[0]) + 1
    assert peak < 250 << 20  # some hundred numbers a node at most, where sets of every step would take 10,000
