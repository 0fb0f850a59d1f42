"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadtables.session import stage


def _size_and_sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def connected(edges: DataFrame) -> DataFrame:
    """`node, root` of every node of `edges` (longs `a`, `b`) but the roots: root is the smallest node it reaches.

    A union-find over tables: each round points nodes at the least neighbour of their neighbours, so paths shrink by
    half or more. A node of any degree is summed up before it is shuffled, and its edges meet in a join that can be
    split. Loops and nulls are ignored, repeated edges count once, no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    before = _size_and_sum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _size_and_sum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
