"""Reports about the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.operators.joins import reconcile_last_login


def login_reconciliation(logins: DataFrame, static: DataFrame) -> DataFrame:
    """Parties whose newest login is not the one their master data states."""
    return reconcile_last_login(logins, static, "party_id", [F.asc("index")])


def static_quality(static: DataFrame) -> DataFrame:
    """Gaps, value counts and date range of the master data as ``(measure, item, n)``, in one pass.

    Dates are given as days since 1970-01-01. An empty table gives no rows.
    """
    day = F.unix_date(F.col("created_on").cast("date")).cast("long")

    def entry(measure: str, item: Column, n: Column = F.lit(1), day: Column = F.lit(None)) -> Column:
        return F.struct(F.lit(measure).alias("measure"), item.alias("item"),
                        n.cast("long").alias("n"), day.cast("long").alias("day"))

    entries = F.array(
        *[entry("missing", F.lit(c), F.col(c).isNull().cast("int")) for c in ("size", "package", "lob_code")],
        *[entry(f"{c} values", F.col(c).cast("string")) for c in ("county", "package", "size")],
        entry("regions of county", F.concat(F.col("county"), F.lit(" "), F.col("region").cast("string"))),
        *[entry("created_on", F.lit(which), day=day) for which in ("first", "last")],
    )
    found = static.select(F.inline(entries)).where(F.col("item").isNotNull()).groupBy("measure", "item")
    n = (
        F.when(F.col("measure") != "created_on", F.sum("n"))
        .when(F.col("item") == "first", F.min("day"))
        .otherwise(F.max("day"))
    )
    return found.agg(n.alias("n"))
