"""Connected components by contraction to the smallest neighbour.

Each round every node that has a smaller neighbour takes the smallest one as its
parent, parents' chains are followed to their ends by pointer jumping, and edges are
rewritten between those ends.  What is left to contract are nodes without a smaller
neighbour, at most half of them, so rounds are logarithmic; stars and cliques end
after the first.  Every edge is read once a round and edges vanish as they contract,
so a large group of nodes costs its own size, not its size times the rounds.

Tables between steps are written to the shared folder (lineage stays short and
survives executor loss); the loop ends when no edge is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.session import stash


def _ordered(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (lo, hi) with lo < hi."""
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()


def chain_ends(parent: DataFrame) -> DataFrame:
    """(v, p) with every p the end of its chain; a chain's length halves each time."""
    while True:
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        parent = stash(parent.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")),
                       "cc-parents")
        if parent.where("moved").isEmpty():
            return parent.select("v", "p")


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "id", src: str = "src",
                         dst: str = "dst") -> DataFrame:
    """(id, component) with component = the smallest node id in the component."""
    left = stash(_ordered(edges, src, dst), "cc-edges")
    label = nodes.select(F.col(node).alias("v")).distinct().withColumn("l", F.col("v"))
    while not left.isEmpty():
        parent = chain_ends(left.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("p")))
        label = label.join(parent.withColumnRenamed("v", "l"), "l", "left").select("v", F.coalesce("p", "l").alias("l"))
        low = parent.select(F.col("v").alias("lo"), F.col("p").alias("a"))
        high = parent.select(F.col("v").alias("hi"), F.col("p").alias("b"))
        moved = left.join(low, "lo", "left").join(high, "hi").select(F.coalesce("a", "lo").alias("a"), "b")
        left = stash(_ordered(moved, "a", "b"), "cc-edges")
    return stash(label, "cc-labels").select(F.col("v").alias(node), F.col("l").alias("component"))
