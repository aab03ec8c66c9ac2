"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Alternates large-star and small-star rounds (Kiveris et al., 2014) until no edge
    changes. Each round is a minimum per node, reduced within tasks before it is shuffled,
    and a join of the edges with it; the side with one row per node is never skewed, so
    adaptive execution may split a node that has many edges. Every round is written to the
    shared folder, so lineage stays short. Self edges and repeated edges are allowed.
    """
    edges = _oriented(edges.select("a", "b"))
    edges = stage(edges, "component-edges")
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "component-edges")
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if (state.n, state.s) == before:
            break
        before = (state.n, state.s)
    # Every edge now leads from a node to its root.
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller."""
    return edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(linked.unionByName(least.select("a", F.col("m").alias("b"))))
