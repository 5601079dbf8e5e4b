"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homespan.session import cut


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Stars (a, b): b is the smallest node reachable from a; nodes without an edge and roots are left out.

    ``edges`` has long columns a and b. Each round hangs every node's larger neighbours, then its smaller ones, on the
    smallest neighbour; rounds grow with the logarithm of a component's size. A node with very many edges is
    one side of a plain equi-join against one row per node, which adaptive execution splits. Every round is cut by a
    reliable checkpoint. Null and self edges are ignored; repeated edges count once.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _signature(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        now = cut(large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())
        after = _signature(now)
        if after == before:
            break
        before = after
    return now
