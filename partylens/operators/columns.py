"""Column names, row filters, duplicates and first rows."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical_name(name: str) -> str:
    """Lower case; ``sum(AMOUNT)`` becomes ``sum_amount``."""
    return re.sub(r"\((.*)\)$", r"_\1", name.strip().lower())


def canonical_columns(df: DataFrame) -> DataFrame:
    """All columns under their canonical names, in one projection."""
    return df.toDF(*[canonical_name(c) for c in df.columns])


def any_flag(*flags: str) -> Column:
    """Rows on which at least one 0/1 flag is set."""
    return reduce(or_, [F.col(flag) == 1 for flag in flags])


def drop_duplicate_rows(df: DataFrame, row_id: str) -> DataFrame:
    """One row per combination of all columns but ``row_id``, with its lowest ``row_id``.

    A plain aggregate: copies collapse before the shuffle, however many there are.
    """
    data = [c for c in df.columns if c != row_id]
    return df.groupBy(*data).agg(F.min(row_id).alias(row_id)).select(*df.columns)


def first_rows(df: DataFrame, key: str, order: list[Column], count: int = 1) -> DataFrame:
    """First ``count`` rows per key.

    Spark cuts each group to ``count`` rows before the shuffle (window group limit),
    so a key that holds a large part of all rows stays cheap.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") <= count).drop("_rank")


def top_rows(df: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first ``count`` rows of the whole table in the given order."""
    return df.orderBy(*order).limit(count)
