"""Grouped statistics. Everything here is pre-aggregated before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partylens.operators.ranking import ranked

STATISTICS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


def statistics_by_key(df: DataFrame, key: str, wanted: dict[str, list[str]], *more: Column) -> DataFrame:
    """All statistics of all columns in a single pass, named ``<statistic>_<column>``.

    Rows without a key are left out.
    """
    columns = [
        STATISTICS[statistic](column).alias(f"{statistic}_{column}")
        for column, names in wanted.items()
        for statistic in names
    ]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*columns, *more)


def histogram(df: DataFrame, *columns: str) -> DataFrame:
    """Number of rows per value, or per combination of values; nulls are not counted."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def ordered_histogram(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    order = F.desc("n") if descending else F.asc("n")
    return histogram(df, column).orderBy(order, column)


def most_common(df: DataFrame, column: str) -> Column:
    """The most frequent value of a column, the lowest of equals, as a scalar."""
    return histogram(df, column).orderBy(F.desc("n"), F.asc(column)).limit(1).select(column).scalar()


def most_common_by(df: DataFrame, group: str, column: str) -> DataFrame:
    """The most frequent value per group, the lowest of equals; null if it has none.

    Counts first, so a group is never held as a whole.
    """
    counts = (
        df.where(F.col(group).isNotNull())
        .groupBy(group, column)
        .agg(F.when(F.col(column).isNotNull(), F.count(F.lit(1))).otherwise(F.lit(0)).alias("n"))
    )
    best = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(column))
    return counts.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").select(group, column)


def pair_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Occurrences per key and value."""
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_lists(df: DataFrame, key: str, value: str, out: str = "entries") -> DataFrame:
    """All values per key, repeats kept, as sorted ``array<struct<value,n>>``.

    The order of a collected list is undefined, so value and count say the same as the
    list, and a key with very many rows still gives a short array. ``spelled_out`` makes the list.
    """
    counts = pair_counts(df, key, value).select(key, F.struct(F.col(value).alias("value"), "n").alias("_e"))
    return counts.groupBy(key).agg(F.array_sort(F.collect_list("_e")).alias(out))


def spelled_out(entries: Column) -> Column:
    """``array<struct<value,n>>`` to the list with repeats."""
    return F.flatten(F.transform(entries, lambda e: F.array_repeat(e["value"], e["n"].cast("int"))))


def entries_text(entries: Column) -> Column:
    """``array<struct<value,n>>`` as text such as ``EUR:3 USD:1``."""
    return F.array_join(F.transform(entries, lambda e: F.concat(e["value"], F.lit(":"), e["n"])), " ")


def vocabulary(df: DataFrame, value: str, rows: str | None = None) -> DataFrame:
    """All terms with their position ``pos``, the most frequent first, equals in alphabetic order.

    ``rows`` names a column with the number of occurrences each row stands for.
    """
    occurrences = F.sum(rows) if rows else F.count(F.lit(1))
    terms = df.dropna(subset=[value]).groupBy(value).agg(occurrences.alias("n"))
    return ranked(terms, [F.desc("n"), F.asc(value)], "pos").select(value, F.col("pos").cast("int").alias("pos"))


def flag_columns(column: str, values: list[str], prefix: str) -> list[Column]:
    """Aggregates, one per listed value: 1 if any row of the group has it, else 0."""
    return [F.max(F.when(F.col(column) == v, 1).otherwise(0)).alias(f"{prefix}{v.lower()}") for v in values]


def flags_by_key(df: DataFrame, key: str, column: str, values: list[str], prefix: str) -> DataFrame:
    """Did the key ever have the value? One 0/1 column per listed value."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*flag_columns(column, values, prefix))


def ranges(df: DataFrame, *columns: str) -> DataFrame:
    """Lowest and highest value of each column, in one row."""
    return df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])


def column_norms(df: DataFrame, columns: list[str]) -> DataFrame:
    """Euclidean length of each column, in one row."""
    return df.agg(*[F.sqrt(F.sum(F.col(c).cast("double") * F.col(c))).alias(c) for c in columns])
