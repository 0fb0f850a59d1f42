"""Ranking rows and joining texts inside groups of any size, on one path for all groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadtables.session import stage


def same(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased tables."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def group_rank(df: DataFrame, keys: list[str], order: list[str], out: str = "rank") -> DataFrame:
    """1..n within each group in the given (unique) order.

    The rows are written once, sorted by range over all groups together, so a group may fill many partitions. A row's
    rank is its place in its partition less the place of its group's first row there, plus the rows of the group in the
    partitions before: only these counts are joined back.
    """
    placed = stage(
        df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    heads = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("head"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = heads.select(*keys, "_part", (F.coalesce(before, F.lit(0)) - F.col("head") + 1).alias("shift"))
    return (
        placed.alias("d").join(offsets.alias("o"), same("d", "o", keys + ["_part"])).select("d.*", "o.shift")
        .withColumn(out, F.col("_place") + F.col("shift")).drop("_place", "_part", "shift")
    )


def join_texts(df: DataFrame, keys: list[str], order: list[str], text: str, separator: str, out: str) -> DataFrame:
    """One cell per group: its texts in order. The cell is one value, so it bounds what is gathered for it."""
    parts = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["_text"]), separator).alias(out))
