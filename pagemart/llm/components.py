"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.session import discard, materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is the component's smallest node.

    Each round hangs the larger neighbours of every node on its smallest one, then the smaller ones. A node's
    smallest neighbour is an aggregate that combines before the shuffle, and it comes back by a join that
    Spark can split, so a node with very many links needs no group of its own. Each round is written to the
    shared folder, which cuts the lineage. The rounds grow with the logarithm of the longest path.
    """
    edges = materialise(_ordered(edges), "links")
    before = _signature(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _ordered(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        former, edges = edges, materialise(_ordered(small.select("e.*")), "links")
        discard(former)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
