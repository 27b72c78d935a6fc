"""One feature row per party from invoices, transfers and master data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.functions.dates import as_timestamp, period_days, whole_days
from partylens.functions.numbers import whole
from partylens.functions.text import as_text, size_band
from partylens.functions.vectors import sparse_text, vector_text
from partylens.operators.aggregates import entries_text, flag_columns, spelled_out, vocabulary
from partylens.operators.columns import drop_duplicate_rows
from partylens.operators.encoders import alphabetic_codes, assembled, with_codes
from partylens.operators.impute import fill_mean, fill_most_common, fill_most_common_by
from partylens.operators.joins import inner_on, inner_with_suffixes
from partylens.schemas import ID_COLUMNS, TEXT_COLUMNS
from partylens.session import stable

KEY = "party_id"
CURRENCY = "currency"

# The currencies of the wide 0/1 layout.
CURRENCIES = ["CAD", "CHF", "CNY", "EUR", "GBP", "HUF", "PLN", "RON", "SEK", "USD"]


def with_invoice_period(invoices: DataFrame) -> DataFrame:
    """Add ``inv_period``, the signed days from issue to due date."""
    start, end = as_timestamp(invoices, "issuedate"), as_timestamp(invoices, "duedate")
    return invoices.withColumn("inv_period", period_days(start, end))


def _features(
    rows: DataFrame, measures: dict[str, list[str]], lists: str, vector: str, spelled: bool, distinct: dict[str, str] | None = None
) -> DataFrame:
    """Statistics per party plus its currencies as list and as count vector, in one pass.

    First per party and currency, which also splits parties with very many rows. That table
    is written, so the raw rows are read once for both the vocabulary and the features. Then
    the few rows left of each party are merged. ``distinct`` names a result and the column whose different known values
    it counts, out of the same pass.
    """
    known = rows.where(F.col(KEY).isNotNull())
    partial: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    merged: list[Column] = []
    for column, names in measures.items():
        partial += [f(column).alias(f"_{f.__name__}_{column}") for f in (F.sum, F.count, F.min, F.max)]
        total, n = F.sum(f"_sum_{column}"), F.sum(f"_count_{column}")
        build = {
            "sum": total, "avg": F.try_divide(total, n),
            "min": F.min(f"_min_{column}"), "max": F.max(f"_max_{column}"),
        }
        merged += [build[name].alias(f"{name}_{column}") for name in names]
    per_currency = known.groupBy(KEY, CURRENCY).agg(*partial) if distinct is None else _with_distinct(known, measures, partial, distinct)
    per_currency = stable(per_currency, "per-currency")
    merged += [F.sum(name).alias(name) for name in distinct or {}]
    terms = vocabulary(per_currency, CURRENCY, rows="_rows")
    placed = per_currency.join(terms, CURRENCY, "left")
    entry = F.struct(F.col(CURRENCY).alias("value"), "pos", F.col("_rows").alias("n"))
    features = placed.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col(CURRENCY).isNotNull(), entry))).alias(lists),
        *merged,
        F.sum("_rows").alias("count"),
    )
    entries = F.col(lists)
    listed = spelled_out(entries) if spelled else entries_text(entries)
    in_vocabulary = F.filter(entries, lambda e: e["pos"].isNotNull())
    by_position = F.array_sort(F.transform(in_vocabulary, lambda e: F.struct(e["pos"].alias("pos"), e["n"].alias("n"))))
    size = terms.agg(F.count(F.lit(1))).scalar()
    others = [c for c in features.columns if c not in (KEY, lists)]
    return features.select(
        KEY, listed.alias(lists), sparse_text(size, by_position).alias(vector), *others
    )


def _with_distinct(known: DataFrame, measures: dict[str, list[str]], partial: list[Column], distinct: dict[str, str]) -> DataFrame:
    """The cells per party and currency, and per party a cell without currency and rows that holds the distinct counts.

    Every row counts for its cell and, without its numbers, for each value to be counted. Both kinds are gathered in one
    aggregate, before the shuffle too, so a party with very many rows or values is spread by its values.
    """
    cell = F.struct(F.lit(None).cast("string").alias("_of"), F.lit(None).cast("string").alias("_value"), F.col(CURRENCY).alias(CURRENCY))
    values = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(name).alias("_of"), F.col(c).cast("string").alias("_value"), F.lit(None).cast(known.schema[CURRENCY].dataType).alias(CURRENCY)))
        for name, c in distinct.items()
    ]
    numbers = [F.when(F.col("_as._of").isNull(), F.col(c)).alias(c) for c in measures]
    doubled = known.withColumn("_as", F.explode(F.array_compact(F.array(cell, *values)))).select(KEY, "_as.*", *numbers)
    first = doubled.groupBy(KEY, "_of", "_value", CURRENCY).agg(*partial)
    again = [F.sum(F.when(F.col("_of").isNull(), F.col("_rows"))).alias("_rows")]
    for column in measures:
        again += [f(f"_{name}_{column}").alias(f"_{name}_{column}") for name, f in (("sum", F.sum), ("count", F.sum), ("min", F.min), ("max", F.max))]
    counts = [F.count_if(F.col("_of") == name).alias(name) for name in distinct]
    return first.groupBy(KEY, "_of", CURRENCY).agg(*again, *counts).drop("_of")


def invoice_features(invoices: DataFrame, spelled: bool = False) -> DataFrame:
    """Amounts, count, invoice periods and currencies per party.

    ``curr`` says ``EUR:3 USD:1``; ``spelled`` gives the list with repeats instead.
    """
    full, no_sum = ["sum", "avg", "min", "max"], ["min", "max", "avg"]
    measures = {"taxinclusiveamount": full, "taxexclusiveamount": full, "inv_period": no_sum}
    return _features(with_invoice_period(invoices), measures, "curr", "currency_vec", spelled)


def transfer_features(transfers: DataFrame, spelled: bool = False) -> DataFrame:
    """Amounts, counts, distinct transfers and currencies per party."""
    measures = {"amount": ["sum", "avg", "min", "max"]}
    return _features(transfers, measures, "transfer_curr", "transfer_currency_vec", spelled, {"uniq_transfer_id_count": "transfer_id"})


def wide_invoice_features(invoices: DataFrame, currencies: list[str] = CURRENCIES) -> DataFrame:
    """Sums, count, a 0/1 column per currency and the shortest and longest period in whole days."""
    start, end = as_timestamp(invoices, "issuedate"), as_timestamp(invoices, "duedate")
    rows = invoices.where(F.col(KEY).isNotNull()).withColumn("_days", whole_days(start, end))
    return rows.groupBy(KEY).agg(
        F.sum("taxexclusiveamount").alias("sum_taxexclusiveamount"),
        F.sum("taxinclusiveamount").alias("sum_taxinclusiveamount"),
        F.count(F.lit(1)).alias("invoice_count"),
        *flag_columns(CURRENCY, currencies, "currency_"),
        F.min("_days").alias("min_inv_period"),
        F.max("_days").alias("max_inv_period"),
    )


def without_copies(static: DataFrame) -> DataFrame:
    """Master data without repeated rows, written once: later steps read a few columns of it."""
    return stable(drop_duplicate_rows(static, "index"), "static")


def with_places(rows: DataFrame) -> DataFrame:
    """Missing counties from the most frequent one, missing regions from that of the county."""
    return fill_most_common_by(fill_most_common(rows, "county"), "region", "county")


def located(static: DataFrame) -> DataFrame:
    """Master data without copies and with county and region filled."""
    return with_places(without_copies(static))


def clean_static(static: DataFrame, size_mode: str = "compat") -> DataFrame:
    """Master data as integers: gaps filled, size band to a number, county and package to codes."""
    rows = without_copies(static)
    # Filling adds no new county and no package, so their codes come from the rows as they are.
    counties = alphabetic_codes(rows, "county")
    texts = rows.withColumn("package", as_text(F.col("package")))
    packages = alphabetic_codes(texts, "package")
    filled = fill_mean(with_places(texts), "lob_code")
    coded = with_codes(with_codes(filled, "county", counties), "package", packages)
    return coded.select(
        "index",
        KEY,
        whole(F.col("lob_code")).cast("long").alias("lob_code"),
        size_band(F.col("size"), size_mode).alias("size"),
        F.col("package").cast("int").alias("package"),
        F.col("region").cast("int").alias("region"),
        F.col("county").cast("int").alias("county"),
    )


def static_features(clean: DataFrame) -> DataFrame:
    """Cleaned master data with the (region, county) vector as text."""
    vectors = assembled(clean, ["region", "county"])
    return vectors.withColumn("features", vector_text(F.col("features")))


def combined_features(invoices: DataFrame, transfers: DataFrame, static: DataFrame) -> DataFrame:
    """Feature row per party that has invoices, transfers and master data."""
    return inner_on(
        KEY,
        invoices.withColumnRenamed("count", "invoices_count"),
        transfers.withColumnRenamed("count", "transfers_count"),
        static,
    )


def combined_with_suffixes(invoices: DataFrame, transfers: DataFrame, static: DataFrame) -> DataFrame:
    """The same rows with ``count_x`` and ``count_y``, without the row number."""
    both = inner_with_suffixes(invoices, transfers, KEY)
    return inner_with_suffixes(both, static.drop("index", "features"), KEY)


def training_rows(combined: DataFrame, include_ids: bool = False) -> DataFrame:
    """Numbers only. Key and row number say nothing about a customer; ``include_ids`` keeps them."""
    dropped = TEXT_COLUMNS + ([] if include_ids else ["index"])
    return combined.drop(*dropped)


def training_columns(rows: DataFrame, include_ids: bool = False) -> list[str]:
    return [c for c in rows.columns if include_ids or c not in ID_COLUMNS]
