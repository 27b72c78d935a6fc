"""Text messages: one CSV line per feature row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partylens.functions.text import part
from partylens.operators.encoders import complete
from partylens.schemas import FEATURE_COLUMNS, MESSAGE

CORRUPT = "_corrupt_record"

# Where and when a message arrived; compared in this order, the later message is the newer one.
ARRIVAL = ["_sent", "_source", "_place"]


def message_stream(spark: SparkSession, fmt: str = "text", **options: str) -> DataFrame:
    """Stream of messages with ``value`` and ``ARRIVAL``: a folder of text files, or any connector.

    For Kafka: ``message_stream(spark, "kafka", subscribe=topic, startingOffsets="earliest",
    **{"kafka.bootstrap.servers": servers})``. Dots in option names may be given as ``__``.
    """
    options = {k.replace("__", "."): str(v) for k, v in options.items()}
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    return decoded(spark.readStream.format(fmt).options(**options).load(), files=fmt == "text")


def decoded(messages: DataFrame, files: bool = False) -> DataFrame:
    """Message bytes as text, with ``ARRIVAL`` where the source tells it.

    A log gives time, partition and offset. Text files (``files``) give their time and name; the lines of a
    file are numbered in the batch, see ``placed``.
    """
    value = F.col("value").cast("string").alias("value")
    if {"timestamp", "partition", "offset"} <= set(messages.columns):
        source = F.concat_ws("-", "topic", "partition") if "topic" in messages.columns else F.col("partition").cast("string")
        arrival = [F.col("timestamp"), source, F.col("offset").cast("long")]
    elif files:
        file = F.col("_metadata")
        name = F.concat(file["file_path"], F.format_string("#%020d", file["file_block_start"]))
        arrival = [file["file_modification_time"], name, F.lit(None).cast("long")]
    else:
        return messages.select(value)
    return messages.select(value, *[c.alias(name) for c, name in zip(arrival, ARRIVAL)])


def placed(batch: DataFrame) -> DataFrame:
    """A batch whose lines of text files are numbered; the numbers grow along a file. Call it before any shuffle."""
    *_, place = ARRIVAL
    if place not in batch.columns:
        return batch
    return batch.withColumn(place, F.coalesce(place, F.monotonically_increasing_id()))


def arrival() -> Column:
    """The version of a message for keyed tables: a later arrival is higher."""
    return F.struct(*ARRIVAL)


def field(line: Column, position: int) -> Column:
    """The field at ``position`` (from 0) of a line without quotes; null when there is none."""
    return part(line, ",", position)


def parsed(messages: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Typed columns next to the raw ``value`` and its arrival, by position and aware of quotes.

    A line that does not fit keeps its text in ``_corrupt_record``.
    """
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [*schema, T.StructField(CORRUPT, T.StringType())])
    row = F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [c for c in ARRIVAL if c in messages.columns]
    return messages.withColumn("_row", row).select("value", *kept, "_row.*")


def reject_reason(columns: list[str] = FEATURE_COLUMNS) -> Column:
    """Why a parsed line cannot be scored; null when it can."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable"))
        .when(F.col("party_id").isNull(), F.lit("no key"))
        .when(~complete(columns), F.lit("missing value"))
    )


def as_messages(df: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Rows as CSV lines in the column order of ``schema``."""
    return df.select(F.to_csv(F.struct(*[F.col(f.name).cast(f.dataType) for f in schema])).alias("value"))


def publish(df: DataFrame, path: str, order: str = "party_id", files: int | None = None,
            limit: int | None = None, schema: T.StructType = MESSAGE) -> None:
    """Replay a table as text files in key order, for a file stream to read.

    ``limit`` sends only the first rows; without it all rows are sent.
    """
    rows = df if limit is None else df.orderBy(order).limit(limit)
    # The hash lets a key with very many rows stretch over several files.
    within = F.xxhash64(*[f.name for f in schema])
    spread = rows.repartitionByRange(*([files] if files else []), F.col(order), within)
    as_messages(spread.sortWithinPartitions(order), schema).write.text(path)


def publish_to_connector(df: DataFrame, fmt: str = "kafka", schema: T.StructType = MESSAGE,
                         key: str = "party_id", **options: str) -> None:
    """Send all rows through an installed connector; equal keys go to the same partition."""
    line = F.to_csv(F.struct(*[F.col(f.name).cast(f.dataType) for f in schema])).alias("value")
    messages = df.select(F.col(key).cast("string").alias("key"), line)
    messages.write.format(fmt).options(**{k.replace("__", "."): v for k, v in options.items()}).save()
