"""Connected components of links between ids, by alternating rounds that turn trees into stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonguemill.session import materialize

MOST_ROUNDS = 100


def _hang_larger(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to u's smallest neighbour (u itself included)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _hang_smaller(edges: DataFrame) -> DataFrame:
    """Of edges that point to the smaller end: all smaller neighbours of u, and u, are linked to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`id` and `component`, its smallest reachable id, for every id that has a link.  edges: u and v, both long.

    Each round is two grouped minima joined back, whose links number no more than before.  It ends when nothing changes,
    which takes a number of rounds that grows with the logarithm of the largest component.
    """
    tidy = lambda e: e.filter("u <> v").distinct()
    edges = materialize(tidy(edges.select("u", "v")), "edges")
    mark = None
    for _ in range(MOST_ROUNDS):
        edges = materialize(tidy(_hang_smaller(_hang_larger(edges))), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
