"""Gapless numbering inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from threadtables.session import stage


def group_slots(df: DataFrame, group: list[str], order: list[str], slot: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 in the given order.

    The rows are sorted by range over all groups together and written once; a group may fill many partitions. Only the
    count of each group in each partition is summed up, so no group meets in one task. Rows equal in group and order
    get any of their numbers. Empty tables stay empty.
    """
    parted = stage(
        df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
        .withColumn("_row", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("_row", 33)
    heads = parted.groupBy(*group, part.alias("_part")).agg(F.min("_row").alias("_head"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    keys = [*group, "_part"]
    return (
        parted.withColumn("_part", part).join(heads.drop("_n"), keys)
        .withColumn(slot, F.col("_row") - F.col("_head") + F.col("_before")).drop("_part", "_row", "_head", "_before")
    )
