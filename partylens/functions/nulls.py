"""Null rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def differs(left: Column, right: Column) -> Column:
    """True unless both are known and equal: a missing value equals nothing."""
    return ~F.coalesce(left == right, F.lit(False))
