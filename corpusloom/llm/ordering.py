"""Positions in a total order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

PART_BITS = 33


def in_order(df: DataFrame, *keys: Column | str, label: str = "order") -> DataFrame:
    """The stored table in order of the keys, with ``_part`` and ``_pos`` inside the part.

    The table is dealt out by ranges of all keys, so a value that a third of the
    rows share is split as long as a later key tells its rows apart. The sampling
    for the ranges reads ``df`` once more: pass a stored or narrow table.
    """
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", PART_BITS))
        .withColumn("_pos", F.col("_at").bitwiseAND((1 << PART_BITS) - 1))
        .drop("_at")
    )
    return stage(numbered, label)


def ranked(ordered: DataFrame) -> DataFrame:
    """Add the global ``_rank`` and the number of rows ``_rows`` to an ordered table.

    What travels to all tasks is one row per part.
    """
    parts = ordered.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn("_rank", F.col("_before") + F.col("_pos"))
        .drop("_before")
    )


def running_totals(ordered: DataFrame, group: str, size: str) -> DataFrame:
    """Add ``_start``, the sum of ``size`` over all earlier rows of the same group.

    The table must be ordered by the group first. Sums run inside parts, parts of a
    group are offset by the totals of the parts before.
    """
    totals = ordered.groupBy(group, "_part").agg(F.sum(size).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_part")
    offsets = totals.select(
        F.col(group).alias("_group"),
        "_part",
        (F.sum("_total").over(earlier) - F.col("_total")).alias("_before"),
    )
    inside = Window.partitionBy("_part", group).orderBy("_pos")
    return (
        ordered.withColumn("_inside", F.sum(size).over(inside) - F.col(size))
        .join(offsets, (ordered[group] == F.col("_group")) & (ordered["_part"] == offsets["_part"]))
        .drop(offsets["_part"])
        .withColumn("_start", F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside", "_group")
    )
