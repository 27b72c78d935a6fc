"""Joins on one key. No hints: Spark knows the sizes and splits skewed partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.functions.nulls import differs, filled
from partylens.operators.columns import first_rows


def inner_on(key: str, *frames: DataFrame) -> DataFrame:
    """Inner join of several tables on one common key column."""
    return reduce(lambda left, right: left.join(right, key, "inner"), frames)


def inner_with_suffixes(
    left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Inner join that marks clashing column names with ``suffixes``."""
    clashes = (set(left.columns) & set(right.columns)) - {key}
    marked = [
        df.toDF(*[c + suffix if c in clashes else c for c in df.columns])
        for df, suffix in zip((left, right), suffixes)
    ]
    return marked[0].join(marked[1], key, "inner")


def keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct known keys. Repeats vanish before the shuffle, and a join on the key reuses it."""
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def keys_in_all(key: str, *frames: DataFrame) -> DataFrame:
    """Keys that occur in every table: one union with a bit per table and one aggregate, whatever the number of tables (63 at most)."""
    if len(frames) > 63:
        raise ValueError("63 tables at most")
    marked = [df.where(F.col(key).isNotNull()).select(key, F.lit(1 << i).cast("bigint").alias("_bit")) for i, df in enumerate(frames)]
    seen = reduce(DataFrame.unionByName, marked).groupBy(key).agg(F.bit_or("_bit").alias("_seen"))
    return seen.where(F.col("_seen") == (1 << len(frames)) - 1).select(key)


def restricted(df: DataFrame, key_table: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``key_table``."""
    return df.join(key_table.select(key), key, "left_semi")


def left_with_defaults(
    left: DataFrame, right: DataFrame, key: str, defaults: dict | None = None
) -> DataFrame:
    """Left join; the columns named in ``defaults`` get that value where nothing matched."""
    joined = left.join(right, key, "left")
    return joined.withColumns({c: filled(F.col(c), v) for c, v in (defaults or {}).items()})


def with_scalar(df: DataFrame, name: str, table: DataFrame, value: Column) -> DataFrame:
    """Add one number about ``table`` (an aggregate without keys) to each row of ``df``."""
    return df.withColumn(name, table.agg(value.alias(name)).scalar())


def reconcile_last_login(
    history: DataFrame, master: DataFrame, key: str, master_order: list[Column]
) -> DataFrame:
    """Keys whose latest login in ``history`` is not the one of their first ``master`` row.

    A missing value on either side, or on both, counts as a difference.
    """
    latest = (
        history.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("last_login").alias("history_login"))
    )
    first = first_rows(master, key, master_order).select(key, F.col("last_login").alias("master_login"))
    seconds = (F.unix_micros("history_login") - F.unix_micros("master_login")) / F.lit(1_000_000)
    return (
        latest.join(first, key, "inner")
        .where(differs(F.col("history_login"), F.col("master_login")))
        .withColumn("seconds_apart", seconds)
    )
