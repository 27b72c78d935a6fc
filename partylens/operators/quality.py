"""Table profiles, summaries and correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.functions.numbers import rounded
from partylens.operators.gram import co_moments
from partylens.operators.ranking import running_sums
from partylens.session import stable

SKETCH = 400  # size of a quantile sketch


def _one_row_per_column(totals: DataFrame, columns: list[str], measures: list[str]) -> DataFrame:
    """``<measure>_<column>`` fields of a one-row table as rows ``(column_name, measures…)``."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}_{c}").alias(m) for m in measures])
        for c in columns
    ])
    return totals.select(F.inline(rows))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, in one pass."""
    columns = columns or df.columns
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])
    return _one_row_per_column(totals, columns, ["nulls"])


def profile_table(df: DataFrame, distinct: bool = False) -> DataFrame:
    """Type, row count and known values per column; ``distinct`` adds an estimated distinct count."""
    columns = df.columns
    measures = ["data_type", "rows", "known"] + (["distinct_estimate"] if distinct else [])
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        aggregates.append(F.count(c).alias(f"known_{c}"))
        if distinct:
            aggregates.append(F.approx_count_distinct(c).alias(f"distinct_estimate_{c}"))
    totals = df.agg(*aggregates)
    types = dict(df.dtypes)
    totals = totals.select(
        "*",
        *[F.lit(types[c]).alias(f"data_type_{c}") for c in columns],
        *[F.col("_rows").alias(f"rows_{c}") for c in columns],
    )
    return _one_row_per_column(totals, columns, measures)


def summary(df: DataFrame, *statistics: str) -> DataFrame:
    """Count, mean, deviation, extremes and approximate quartiles of all columns."""
    return df.summary(*statistics)


def sketch_error(size: int = SKETCH) -> float:
    """Bound of the rank error of a sketch: twice what 99 of 100 quantiles keep."""
    return 2 * 2.296 / size**0.9021


def sketched_summary(
    df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.25, 0.5, 0.75), size: int = SKETCH
) -> DataFrame:
    """Count, mean, deviation, extremes and quantiles of all columns in one pass, a row per column.

    Quantiles ``p25 …`` come from mergeable sketches of a few kilobytes per column, whose ranks are off by ``sketch_error(size)``
    at most; everything else is exact. A column without values has a count of 0 and gaps.
    """
    numbers = {c: F.col(c).cast("double") for c in columns}
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    totals = df.agg(
        *[f(x).alias(f"{m}_{c}") for m, f in measures.items() for c, x in numbers.items()],
        *[F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(size)).alias(f"sketch_{c}") for c, x in numbers.items()])
    names = {f"p{round(100 * p)}": p for p in probabilities}
    rows = _one_row_per_column(totals, columns, [*measures, "sketch"])
    return rows.select("column_name", *measures, *[
        F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name) for name, p in names.items()])


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Exact interpolated quantiles as rows ``(column_name, probability, quantile)``.

    ``percentile`` would hold all distinct values of a column in one task. Here each value is counted once,
    the values of all columns are spread by range, and a value's last rank is its place in its piece plus what
    lies in the pieces before; only one number per piece and column passes through a single task. Columns
    without values give no rows.
    """
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = df.select(F.inline(listed)).where(F.col("value").isNotNull()).groupBy("column_name", "value")
    counts = counts.agg(F.count(F.lit(1)).alias("_rows"))
    placed = running_sums(counts, "_rows", ["column_name"], [F.col("value")], "_upto")
    totals = placed.groupBy("column_name").agg(F.max("_upto").alias("_all"))
    # One row per column on this side.
    targets = totals.select("column_name", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"),
                            F.col("_all").alias("_all"))
    spot = (F.col("_all") - 1) * F.col("probability")
    last = F.col("_upto") - 1
    first = F.col("_upto") - F.col("_rows")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank <= last), F.col("value")))

    hits = placed.join(F.broadcast(targets), "column_name").where((first <= F.ceil(spot)) & (F.floor(spot) <= last))
    low, high = at(F.floor(spot)), at(F.ceil(spot))
    return hits.groupBy("column_name", "probability").agg(
        (low + (high - low) * F.max(spot - F.floor(spot))).alias("quantile"))


def describe_exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    df = stable(df.select(*columns), "described")
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    totals = df.agg(*[
        f(F.col(c)).cast("long" if m == "count" else "double").alias(f"{m}_{c}")
        for m, f in measures.items() for c in columns
    ])
    basics = _one_row_per_column(totals, columns, list(measures))
    quartiles = (
        exact_quantiles(df, columns)
        .groupBy("column_name")
        .pivot("probability", [0.25, 0.5, 0.75])
        .agg(F.first("quantile"))
        .toDF("column_name", "p25", "p50", "p75")
    )
    return basics.join(quartiles, "column_name", "left")


def correlation_matrix(df: DataFrame, columns: list[str], digits: int | None = 2) -> DataFrame:
    """Pearson correlations of all column pairs as rows ``(a, b, r)``, from one pass over the rows.

    A pair counts the rows where both are known. What does not vary there, or is never known, has no r.
    """
    columns = list(dict.fromkeys(columns))
    found = co_moments(df, columns)
    r = F.when((F.col("m_a") > 0) & (F.col("m_b") > 0), F.col("c") / (F.sqrt("m_a") * F.sqrt("m_b")))
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    found = found.select(F.explode(F.array_distinct(both)).alias("_p"), r.alias("_r"))
    # greatest and least would turn an unknown r into a bound.
    bounded = F.when(F.col("_r").isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "_r")))
    return found.select("_p.*", _shown(bounded, digits).alias("r"))


def _shown(r: Column, digits: int | None) -> Column:
    return r if digits is None else rounded(r, digits)
