"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import materialise


def _minima(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest node among u and its neighbours. Written out so that joins on a hub stay splittable."""
    return materialise(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-minima")


def _large_star(edges: DataFrame) -> DataFrame:
    both = materialise(edges.union(edges.select("v", "u")), "star-both")
    return (both.join(_minima(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "star-down")
    minima = _minima(down)
    return (down.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(minima.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of the component.

    Edges with a null or equal ends are ignored; direction and repeats don't matter. Every round
    moves each node to the smallest node its neighbourhood knows, so components of any diameter
    settle in a logarithmic number of rounds; each round's edges are written to the shared folder.
    """
    now = materialise(edges.toDF("u", "v").where("u is not null and v is not null and u <> v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        now = materialise(_small_star(_large_star(now)), "edges")
        after = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if after == mark:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(now.select("v", "v").distinct())
        mark = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
