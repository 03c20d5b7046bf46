"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges u, v with ``least``, the smallest node among u and its neighbours."""
    least = edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low"))
    return edges.join(least, edges["u"] == least["at"]).select("u", "v", F.least("u", "low").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _with_least(edges)
    moved = found.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(found.select("u", F.col("least").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node id reachable) for every node on an edge ``a``, ``b``.

    Each round is written to the shared folder, so no round is computed twice and a lost executor
    costs only its own tasks. The number of rounds grows with the logarithm of the longest path.
    Edges between a node and itself and null ends are ignored.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = materialize(ends.distinct(), "edges")
    before = _state(stars)
    while before[0]:
        stars = materialize(_small_star(_large_star(stars)), "edges")
        after = _state(stars)
        if after == before:
            break
        before = after
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
