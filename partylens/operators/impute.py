"""Missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.operators.aggregates import most_common, most_common_by


def fill_most_common(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), most_common(df, column)))


def fill_most_common_by(df: DataFrame, column: str, group: str) -> DataFrame:
    """Missing values from the most frequent value of the row's group."""
    best = most_common_by(df, group, column).withColumnRenamed(column, "_best")
    return (
        df.join(best, group, "left")
        .withColumn(column, F.coalesce(F.col(column), F.col("_best")))
        .select(*df.columns)
    )


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), df.agg(F.avg(column)).scalar()))
