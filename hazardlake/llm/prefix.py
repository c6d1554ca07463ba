"""Distributed running totals over a global or per-group order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.llm.staging import bounded, drop, stage


def running_total(df: DataFrame, order: list[Column], out: str, value: str | None = None,
                  groups: list[str] | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (rows if None) over all earlier rows of the group.

    The rows are range-sorted by group and order, so a group of any size spreads
    over many partitions; each partition adds up its own rows, and the sums of
    earlier partitions (one row per group and partition) are added as an offset.
    The sorted rows are written first, so a lost executor cannot renumber them.
    Rows that tie in ``order`` are counted in any order; null groups are groups.
    """
    groups = groups or []
    amount = F.col(value).cast("long") if value else F.lit(1).cast("long")
    placed = stage(df.orderBy(*[F.col(g).asc_nulls_last() for g in groups], *order)
                   .withColumn("_part", F.spark_partition_id())
                   .withColumn("_at", F.monotonically_increasing_id()), "sorted")
    own = Window.partitionBy("_part", *groups).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*groups, "_part").agg(F.sum(amount).alias("_sum"))
    offsets = stage(sums.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                                F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")), "offsets")
    inside = placed.withColumn("_inside", F.sum(amount).over(own) - amount)
    same = reduce(lambda a, b: a & b, [F.col("_part") == F.col("_p")] + [
        F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
    summed = inside.join(bounded(offsets, 64), same).withColumn(out, F.col("_inside") + F.col("_offset"))
    result = stage(summed.select(*df.columns, out), "running")
    drop(placed, offsets)
    return result
