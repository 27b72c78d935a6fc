"""Categories as codes, 0/1 columns, count vectors and feature vectors."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.functions.numbers import scaled
from partylens.operators.aggregates import (
    column_norms,
    histogram,
    pair_counts,
    vocabulary,
)
from partylens.operators.ranking import ranked

# Most values that `one_hot` may turn into columns; beyond it use `one_hot_vector`.
MAX_FLAG_COLUMNS = 1_000

def alphabetic_codes(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Each distinct known value with its position in sorted order."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return ranked(values, [F.asc(column)], out)


def frequency_codes(df: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Each distinct known value with its position by falling frequency, equals sorted."""
    return ranked(histogram(df, column), [F.desc("n"), F.asc(column)], out).drop("n")


def with_codes(df: DataFrame, column: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """Replace the values of ``column`` by their codes."""
    return (
        df.join(codes.select(column, F.col(code).alias("_code")), column, "left")
        .withColumn(column, F.col("_code"))
        .select(*df.columns)
    )


def listed_values(df: DataFrame, column: str, most: int = MAX_FLAG_COLUMNS) -> list:
    """Sorted distinct values, for use as columns; an error if there are more than ``most``."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; use one_hot_vector")
    return sorted(row[0] for row in found)


def one_hot(df: DataFrame, column: str, values: list, prefix: str = "", weight: float = 1) -> DataFrame:
    """A column per value: ``weight`` where the row has the value, else 0."""
    flags = {
        f"{prefix}{v}": F.when(F.col(column) == v, F.lit(weight)).otherwise(F.lit(type(weight)(0)))
        for v in values
    }
    return df.select("*", *[flag.alias(name) for name, flag in flags.items()])


def one_hot_vector(df: DataFrame, column: str, out: str, order: str = "frequency") -> DataFrame:
    """Sparse 0/1 vector over all values of a column, the last one included; null gives zeros.

    ``order``: ``frequency`` or ``alphabet``. The values are numbered in a table of their own and joined;
    the fitted encoder only holds their number.
    """
    index = f"{out}_index"
    codes = (frequency_codes if order == "frequency" else alphabetic_codes)(df, column, index)
    codes = codes.select(column, F.col(index).cast("double").alias(index))
    # What the encoder has not seen is the category it leaves out.
    encoder = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True, handleInvalid="keep").fit(codes)
    indexed = df.join(codes, column, "left").withColumn(index, F.coalesce(index, F.lit(float((1 << 31) - 1))))
    return encoder.transform(indexed).select(*df.columns, out)


def count_entries(counts: DataFrame, key: str, value: str, terms: DataFrame, out: str) -> DataFrame:
    """Per key the sorted ``array<struct<pos,n>>`` over the positions in ``terms``.

    ``counts`` has one row per key and value. ``terms`` comes from ``vocabulary``.
    """
    placed = counts.join(terms, value, "inner")
    return placed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias(out))


def count_vectors(df: DataFrame, key: str, value: str, out: str = "entries") -> DataFrame:
    """Bag of values per key over the vocabulary of the whole table."""
    known = df.where(F.col(key).isNotNull())
    return count_entries(pair_counts(known, key, value), key, value, vocabulary(known, value), out)


def dense_counts(entries: Column, terms: int) -> Column:
    """``array<struct<pos,n>>`` as one count per position."""
    at = F.map_from_entries(entries)
    positions = F.sequence(F.lit(0), F.lit(terms - 1))
    return F.transform(positions, lambda p: F.coalesce(F.try_element_at(at, p), F.lit(0).cast("long")))


def assembled(df: DataFrame, columns: list[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Number columns as one vector. ``invalid``: ``error`` or ``skip`` for null and NaN rows."""
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=invalid).transform(df)


def complete(columns: list[str]) -> Column:
    """True for rows the assembler accepts: no null and no NaN."""
    ok = F.lit(True)
    for column in columns:
        ok = ok & F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    return ok


def unit_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale each column to Euclidean length 1."""
    norms = column_norms(df, columns).select(F.struct(*columns)).scalar()
    rows = df.withColumn("_norms", norms)
    return rows.withColumns({c: scaled(F.col(c), F.col("_norms")[c]) for c in columns}).drop("_norms")
