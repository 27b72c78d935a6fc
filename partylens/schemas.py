"""Table layouts: column types, keys, and the one feature order used for training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "text": T.StringType(), "time": T.TimestampType(), "date": T.DateType(),
}


def layout(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Raw files. Dates stay text here: unreadable ones must become null, not fail the job.
RAW_INVOICES = layout(
    index="long", party_id="long", duedate="text", issuedate="text", taxpointdate="text",
    currency="text", taxinclusiveamount="double", taxexclusiveamount="double", payableamount="double",
)
RAW_TRANSFERS = layout(
    index="long", party_id="long", transfer_id="text", amount="double", currency="text", value_date="text",
)
RAW_LOGINS = layout(index="long", party_id="long", last_login="text")
RAW_STATIC = layout(
    index="long", party_id="long", created_on="text", last_login="text", county="text",
    region="int", size="text", package="text", lob_code="double",
)
CLEAN_STATIC = layout(
    index="long", party_id="long", lob_code="long", size="int", package="int", region="int", county="int",
)

# Feature and result tables with their keys. Lists of currencies are kept as `EUR:3 USD:1`.
INVOICES = layout(
    party_id="long", curr="text", currency_vec="text",
    sum_taxinclusiveamount="double", avg_taxinclusiveamount="double",
    min_taxinclusiveamount="double", max_taxinclusiveamount="double",
    sum_taxexclusiveamount="double", avg_taxexclusiveamount="double",
    min_taxexclusiveamount="double", max_taxexclusiveamount="double",
    count="long", min_inv_period="double", max_inv_period="double", avg_inv_period="double",
)
TRANSFERS = layout(
    party_id="long", transfer_curr="text", transfer_currency_vec="text",
    sum_amount="double", avg_amount="double", min_amount="double", max_amount="double",
    count="long", uniq_transfer_id_count="long",
)
STATIC = layout(
    party_id="long", index="long", lob_code="long", size="int", package="int",
    region="int", county="int", features="text",
)
PREDICTIONS = layout(party_id="long", features="text", prediction="int")
PREDICTIONS_BY_FEATURES = layout(features="text", prediction="int")
LOGINS = layout(id="long", last_login="time", party_id="long")
REJECTS = layout(value="text", reason="text")

TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "invoices": (INVOICES, ("party_id",)),
    "transfer_history": (TRANSFERS, ("party_id",)),
    "static_data": (STATIC, ("party_id",)),
    "predictions": (PREDICTIONS, ("party_id",)),
    "predictions_by_features": (PREDICTIONS_BY_FEATURES, ("features",)),
    "customer_login": (LOGINS, ("id",)),
}

# One line of the feature stream, by position.
MESSAGE = layout(
    party_id="long", curr="text", currency_vec="text",
    sum_taxinclusiveamount="double", avg_taxinclusiveamount="double",
    min_taxinclusiveamount="double", max_taxinclusiveamount="double",
    sum_taxexclusiveamount="double", avg_taxexclusiveamount="double",
    min_taxexclusiveamount="double", max_taxexclusiveamount="double",
    invoices_count="long", min_inv_period="double", max_inv_period="double", avg_inv_period="double",
    transfer_curr="text", transfer_currency_vec="text",
    sum_amount="double", avg_amount="double", min_amount="double", max_amount="double",
    transfers_count="long", uniq_transfer_id_count="long",
    lob_code="long", size="int", package="int", region="int", county="int",
)

TEXT_COLUMNS = ["curr", "currency_vec", "transfer_curr", "transfer_currency_vec", "features"]
ID_COLUMNS = ["party_id", "index"]

# Everything numeric in a message but the key, in message order: the model's input.
FEATURE_COLUMNS = [f.name for f in MESSAGE if f.name not in TEXT_COLUMNS + ID_COLUMNS]


def conform(df: DataFrame, table: str, keep: list[str] = []) -> DataFrame:
    """Columns of ``df`` in the order and types of a declared table, then ``keep``; an error names missing ones."""
    wanted, _ = TABLES[table]
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {table} needs the columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in wanted], *keep)
