"""Numbering of rows in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partylens.session import stable


def ranked(df: DataFrame, order: list[Column], out: str = "code") -> DataFrame:
    """Rows numbered from 0 in the given order, for tables of any length."""
    counted = running_sums(df.withColumn("_one", F.lit(1).cast("long")), "_one", [], order, out)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")


def running_sums(df: DataFrame, value: str, groups: list[str], order: list[Column], out: str) -> DataFrame:
    """Sum of ``value`` over the rows of a group up to this row, in an order without ties, for tables of any length.

    The rows are spread by range and written; each piece sums its rows on its own and adds what lies
    in the pieces before it, so only one number per piece and group passes through a single task.
    """
    by_range = df.repartitionByRange(*[F.col(g) for g in groups], *order)
    pieces = stable(by_range.withColumn("_piece", F.spark_partition_id()), "pieces")
    before = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("_piece", *groups)
        .agg(F.sum(value).alias("_n"))
        .select("_piece", *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_piece", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        pieces.withColumn("_within", F.sum(value).over(within))
        .join(F.broadcast(starts), ["_piece", *groups])
        .withColumn(out, F.col("_start") + F.col("_within"))
        .select(*df.columns, out)
    )
