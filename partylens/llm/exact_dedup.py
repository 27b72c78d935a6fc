"""Exact duplicates with a heavy-hitter split. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partylens.session import stable

TRACKED = 1024  # counters of a summary
WINNERS = 256  # digests handled without a shuffle at most
LANES = 64  # summaries built next to each other before they are merged


def normal_text(text: Column) -> Column:
    """White space runs become one blank; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def frequent(digests: DataFrame, digest: str, tracked: int = TRACKED, winners: int = WINNERS) -> DataFrame:
    """At most ``winners`` digests that may be frequent, from merged Misra-Gries summaries.

    The summary is Spark's frequent-items sketch, a Misra-Gries variant with ``tracked`` counters whose
    merge adds counters and cuts them back. Tasks summarise their own rows; the summaries of a lane are
    merged first and then those of all lanes, so what is sent is tasks times ``tracked`` counters.
    """
    lanes = digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane")).agg(
        F.expr(f"approx_top_k_accumulate({digest}, {tracked})").alias("summary")
    )
    one = lanes.groupBy(F.pmod("lane", F.lit(1)))  # grouped, so that a task without rows sends no summary
    merged = one.agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {winners})").alias("top"))
    return merged.select(F.explode("top").alias("found")).select(F.col("found.item").alias(digest)).where(F.col(digest).isNotNull())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED, winners: int = WINNERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after ``normal_text``; the smallest id stays. Verified frequent
    digests (at most ``winners`` rows) are broadcast and settle their rows where they lie; all other
    digests go through one ordinary shuffle. Rows that repeat an id count each, and each of them is
    kept when its id is; a null id never is the smallest unless the whole group has none, then
    keep_id is null and those rows stay. Other columns of ``docs`` are not read. An empty table
    gives an empty result.
    """
    digests = stable(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.encode(normal_text(F.col(text_col)), "UTF-8"), 256).alias("text_sha256")),
        "digests",
    )
    names = frequent(digests, "text_sha256", tracked, winners)
    verified = stable(
        digests.join(F.broadcast(names), "text_sha256", "left_semi")
        .groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )  # exact figures of at most ``winners`` digests
    heavy = digests.join(F.broadcast(verified), "text_sha256")
    group = Window.partitionBy("text_sha256")
    light = digests.join(F.broadcast(verified), "text_sha256", "left_anti").withColumns(
        {"keep_id": F.min("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)}
    )
    return heavy.unionByName(light).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
