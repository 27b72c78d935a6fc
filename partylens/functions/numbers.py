"""Rates, scaling, rounding and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_DAYS = 30


def monthly_rate(amount: Column, days: Column) -> Column:
    """``amount`` per 30 days, rounded half to even; zero or unknown days give null."""
    per_month = F.try_divide(amount.cast("double"), days) * F.lit(MONTH_DAYS)
    return F.bround(per_month).try_cast("long")


def scaled(value: Column, norm: Column) -> Column:
    """``value / norm``; a zero norm leaves the value as it is."""
    return F.when(norm == 0, value.cast("double")).otherwise(F.try_divide(value, norm))


def rounded(value: Column, digits: int = 2) -> Column:
    """Rounded value; adding zero turns ``-0.0`` into ``0.0``."""
    return F.round(value, digits) + F.lit(0.0)


def whole(value: Column) -> Column:
    """Integer part (cut towards zero)."""
    return value.try_cast("long")


def number(text: Column, kind: str = "double") -> Column:
    """Text to number; what is no number becomes null."""
    return F.trim(text).try_cast(kind)


def replaced(value: Column, mapping: dict) -> Column:
    """Swap the listed values and keep all others."""
    out = value.cast("double")
    for old, new in mapping.items():
        out = F.when(value == F.lit(old), F.lit(float(new))).otherwise(out)
    return out
