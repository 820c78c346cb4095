"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.tables import stored


def components(pairs: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, root`` for every node of ``pairs`` (a, b); the root is the component's smallest node.

    A large star points each greater neighbour at the smallest node around, a small star does so with
    the smaller ones, until every edge leads to its root. Neighbourhoods are only aggregated and joined,
    never gathered. Each round is written to the shared folder; the driver sees a count and a sum.
    """
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges, before = stored(edges.distinct(), "edges"), None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "edges")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).head()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours, pointed at the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
        "u <> v"
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, pointed at the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).where("u <> v").distinct()
