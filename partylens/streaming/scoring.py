"""Score a stream of feature messages into a keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from partylens.functions.vectors import vector_text
from partylens.operators.encoders import assembled
from partylens.schemas import FEATURE_COLUMNS
from partylens.sources.keyed import merge, upsert, write_table
from partylens.streaming.messages import arrival, parsed, placed, reject_reason

EVERY_FIVE_SECONDS = {"processingTime": "5 seconds"}
EVERY_SECOND_CONTINUOUS = {"continuous": "1 second"}
ALL_AVAILABLE = {"availableNow": True}


def scored(features: DataFrame, model: Transformer, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Cluster per row; rows with a missing feature are skipped. Batch or stream."""
    rows = features.drop("features")
    return model.transform(assembled(rows, columns, invalid="skip"))


def score_messages(
    messages: DataFrame,
    model: Transformer,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    columns: list[str] = FEATURE_COLUMNS,
) -> StreamingQuery:
    """Start the query: parse, score, upsert into ``predictions``; bad lines go to ``rejects``.

    Both tables are written per query and batch number: a batch that is repeated after a failure replaces
    itself, and a query with a checkpoint of its own adds to what others wrote. Of several messages of a party
    the last to arrive counts.
    """
    rows = parsed(messages).withColumn("reason", reject_reason(columns))

    def store(batch: DataFrame, number: int) -> None:
        writer = query_id(batch)
        batch = placed(batch).persist()
        try:
            good = batch.where(F.col("reason").isNull())
            scores = scored(good, model, columns).withColumn("features", vector_text(F.col("features")))
            write_table(scores, root, "predictions", arrival(), writer, number)
            bad = batch.where(F.col("reason").isNotNull()).select("value", "reason")
            bad.write.mode("overwrite").parquet(f"{root}/rejects/writer={writer}/batch={number}")
        finally:
            batch.unpersist()

    return per_batch(rows, store, checkpoint, trigger)


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that runs this batch; it lives as long as the query's checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def per_batch(
    stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``store``; every 5 seconds unless told otherwise."""
    return (
        stream.writeStream.trigger(**(trigger or EVERY_FIVE_SECONDS))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .start()
    )


def upsert_stream(stream: DataFrame, path: str, keys: tuple[str, ...], version: Column, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep a keyed table in step with a stream; ``version`` tells which row of a key is newer."""

    def store(batch: DataFrame, number: int) -> None:
        upsert(placed(batch), path, keys, version, query_id(batch), number)

    return per_batch(stream, store, checkpoint, trigger)


def newest_stream(stream: DataFrame, keys: tuple[str, ...], version: str, event_time: str, delay: str, span: str) -> DataFrame:
    """Streaming rows with the highest ``version`` per key and ``span`` of event time, kept in the state store.

    In update mode a trigger gives the keys whose newest row changed; repeated and older messages change nothing and give
    nothing. Messages later than ``delay`` behind the newest event time are dropped, and spans that old leave the state.
    """
    others = [c for c in stream.columns if c not in (*keys, version, event_time)]
    # A watermark needs the event time itself, so the newest row carries a copy.
    held = stream.withColumn("_at", F.col(event_time)).withWatermark(event_time, delay)
    newest = held.groupBy(*keys, F.window(event_time, span).alias("_span")).agg(F.max(F.struct(version, "_at", *others)).alias("_newest"))
    fields = {c: F.col("_newest")["_at" if c == event_time else c] for c in stream.columns if c not in keys}
    return newest.select(*[F.col(c) if c in keys else fields[c].alias(c) for c in stream.columns])


def keep_newest(
    stream: DataFrame, path: str, keys: tuple[str, ...], version: str, event_time: str, checkpoint: str,
    delay: str = "1 hour", span: str = "1 hour", merge_every: int = 100, buckets: int = 64, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a keyed table in step with a stream by its state: a batch writes only keys with a newer row, and every
    ``merge_every`` batches the table is merged, so that its files do not grow with the number of batches."""
    spark = stream.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        upsert(batch, path, keys, version, query_id(batch), number)
        if number % merge_every == merge_every - 1:
            merge(spark, path, keys, buckets)

    newest = newest_stream(stream, keys, version, event_time, delay, span)
    return (
        newest.writeStream.outputMode("update").trigger(**(trigger or EVERY_FIVE_SECONDS))
        .option("checkpointLocation", checkpoint).foreachBatch(store).start()
    )


def echo(messages: DataFrame, checkpoint: str, trigger: dict | None = None, path: str | None = None) -> StreamingQuery:
    """Show the raw messages on the console, or write them as text to ``path``.

    The continuous trigger needs a source that supports it (Kafka, rate); files do not.
    """
    writer = messages.select("value").writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or EVERY_SECOND_CONTINUOUS))
    if path is None:
        return writer.format("console").start()
    return writer.format("text").option("path", path).start()
