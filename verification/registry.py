"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verification.fixtures import SQL_VIEWS, Business

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


MEAN_DIGITS = {"avg_taxinclusiveamount": 1, "avg_taxexclusiveamount": 1, "avg_amount": 8}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of ``Business`` as query; ``views`` are more WITH entries."""

    def add(build: Callable[[Business], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, folder: build(Business(spark, folder))
        if sql is not None:
            SQL[name] = f"{SQL_VIEWS}{views}\n{sql.strip()}"
        return build

    return add


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded, without negative zero."""
    return F.round(column, digits) + F.lit(0.0)


def tidy(df: DataFrame, digits: int = 6, **others: int) -> DataFrame:
    """All double columns rounded, ``others`` to their own digits.

    Sums of money end at six decimals here, so six digits only remove float noise. Means get
    digits at which no value of the test data lies exactly between two results.
    """
    others = {**MEAN_DIGITS, **others}
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[r(c, others.get(c, digits)).alias(c) if c in doubles else F.col(c) for c in df.columns])
