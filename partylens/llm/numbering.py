"""Running sums per group in a hashed order, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096  # slices of each group by the leading bits of the order hash


def running_before(df: DataFrame, group: str, order: list[str], value: str, into: str) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows of ``group`` that come before.

    Rows stand by ``order``, whose first column must be a 64-bit hash: its leading bits cut every group
    into ``BUCKETS`` slices, so a group with a third of all rows is spread over thousands of tasks. The
    sums per slice are pre-aggregated; their running totals are one row per slice and join the rows where
    these already lie. ``group`` must not be null.
    """
    bits = BUCKETS.bit_length() - 1
    sliced = df.withColumn("_slice", F.shiftrightunsigned(F.col(order[0]), 64 - bits).cast("int"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(group, "_slice").agg(F.sum(value).alias("_sum")).select(
        F.col(group).alias("_group"), F.col("_slice").alias("_at"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier")
    )
    inside = Window.partitionBy(group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(totals, (F.col(group) == F.col("_group")) & (F.col("_slice") == F.col("_at")))
    return joined.withColumn(into, F.col("_earlier") + F.col("_inside")).drop("_slice", "_group", "_at", "_earlier", "_inside")
