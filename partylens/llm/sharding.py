"""Sharding by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.llm.numbering import running_before


def rendezvous(key: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard with the best score for the key: weight / -log of a uniform hash of (key, shard).

    A shard's scores depend on nothing but the key and itself, so a further shard only takes keys
    away to itself, and a change of one weight only moves keys from or to that shard. A weight of 0
    gets nothing. Equal scores go to the lower shard.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("a shard needs a positive weight")

    def score(shard: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 11)
        return F.lit(float(weights[shard])) / -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53)))

    scored = [F.struct(score(i).alias("score"), F.lit(-i).alias("shard")) for i in range(len(weights)) if weights[i] > 0]
    return -(F.greatest(*scored) if len(scored) > 1 else scored[0])["shard"]


def shard_rows(docs: DataFrame, weights: Sequence[float], key_cols: Sequence[str] = ("doc_id",), text_col: str = "text", grown: Sequence[float] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """The key columns and those of ``carry`` with size, text_crc32, law, shard, slot and grown_shard of every row.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` of those bytes (null as empty). The law is
    ``key``: only the key and the weights decide, so rows that repeat a key share a shard; null keys are
    keys like others. ``slot`` numbers the rows of a shard from 0 without gaps, in an order hashed
    from key, size and checksum, so that rows which repeat one key are spread (of equal rows any order is the same table). ``grown_shard`` is
    the shard under the weights ``grown``, null without them. Other columns are not read; a carried column
    with the name of a new one gives way to it. ``docs`` is read twice, the second time for its keys only.
    """
    key = [F.col(c) for c in key_cols]
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    carry = [c for c in carry if c not in (*new, *key_cols)]
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    placed = docs.select(
        *key, *carry, (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"),
        rendezvous(key, weights).cast("int").alias("shard"),
        (rendezvous(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"), F.lit(1).cast("bigint").alias("_one"),
    ).withColumn("_order", F.xxhash64(*key, "size", "text_crc32", F.lit("slot")))
    return running_before(placed, "shard", ["_order", *key_cols, "size", "text_crc32"], "_one", "slot").select(*key_cols, *carry, *new)
