"""Dates, periods and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
DAY_MICROS = DAY_SECONDS * 1_000_000


def as_timestamp(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd") -> Column:
    """Column ``name`` as a timestamp; unreadable text gives null, not an error."""
    if df.schema[name].dataType.typeName() == "string":
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.col(name).cast("timestamp")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def period_days(start: Column, end: Column) -> Column:
    """Signed number of days from ``start`` to ``end``, with fractions."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(DAY_SECONDS)


def whole_days(start: Column, end: Column) -> Column:
    """Full days from ``start`` to ``end``, rounded down (also below zero)."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return ((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("long")
