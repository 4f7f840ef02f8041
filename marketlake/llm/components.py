"""Connected components of a graph held as an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no node's neighbours meet in one task: the minimum is taken
partly before the shuffle, and the join's long side can be split by adaptive execution. The edge table never
grows beyond its size, is written to the shared folder after each round, and the rounds end when nothing
changes; their number grows with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.skew import apart
from marketlake.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = apart(both.groupBy("a").agg(F.min("b").alias("least")), "a")
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these; all edges have a > b."""
    least = apart(edges.groupBy("a").agg(F.min("b").alias("least")), "a")
    moved = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component of every node that has an edge (columns a, b of one orderable type); the component is
    its smallest node. Loops, repeated edges and edges with a null end do not matter."""
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(edges["a"].isNotNull() & edges["b"].isNotNull()).filter("a != b").distinct(),
        "edges",
    )
    state = _state(current)
    for _ in range(most_rounds):
        if not state[0]:
            break
        current = stored(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    node = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return node.unionByName(node.select(F.col("component").alias("node"), "component").distinct())
