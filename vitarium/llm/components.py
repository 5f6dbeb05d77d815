"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitarium.session import stored


def _to_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour ``m`` of each u; a hot u is one row per task, and its
    join is one that adaptive execution splits."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _both(edges: DataFrame) -> DataFrame:
    """Each edge once from either end; one scan, no union."""
    ends = F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    return edges.select(ends.alias("e")).select("e.u", "e.v")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node that is not the least of its component.

    Nodes are numbers; a component is named by its least one.  Each round is written to the
    shared scratch folder, so a lost executor costs one round at most.
    """
    state = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        big = _to_least(_both(state)).filter("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = _to_least(big)
        star = F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        state = stored(small.select(star.alias("e")).select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
