"""Which values a key has ever had, as bits: vocabularies of any size, one aggregate, no column per value.

Bit ``pos`` of a key is set if it has the value at that position of the vocabulary. Bits are kept in words of 64, and only
words with a bit are kept, so a key costs what it has, not what the vocabulary holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partylens.operators.aggregates import vocabulary

WORD = 64


def value_bitmaps(df: DataFrame, key: str, value: str, terms: DataFrame | None = None, out: str = "bits") -> DataFrame:
    """Per key the sorted ``array<struct<word:int,bits:bigint>>`` of its values; keys without a known value have an empty one.

    ``terms`` numbers the values (``vocabulary``, the default, or ``alphabetic_codes`` renamed); values outside of it have no bit.
    Bits of the same word are or-ed before the shuffle. Rows without a key are left out.
    """
    known = df.where(F.col(key).isNotNull())
    terms = vocabulary(known, value) if terms is None else terms
    placed = known.select(key, value).join(terms.select(F.col(value).alias("_value"), F.col("pos").cast("int").alias("pos")), F.col(value) == F.col("_value"), "left")
    word, bit = F.floor(F.col("pos") / WORD).cast("int"), F.col("pos") % WORD
    words = placed.groupBy(key, word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits"))
    entry = F.when(F.col("word").isNotNull(), F.struct("word", "bits"))
    return words.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias(out))


def bitmap_positions(bits: Column) -> Column:
    """The set positions, in order."""
    inside = F.sequence(F.lit(0), F.lit(WORD - 1))
    of_word = lambda w: F.transform(
        F.filter(inside, lambda i: F.call_function("shiftright", w["bits"], i).bitwiseAND(F.lit(1)) == 1), lambda i: w["word"] * WORD + i)
    return F.flatten(F.transform(bits, of_word))


def bitmap_flag(bits: Column, pos: int) -> Column:
    """1 if the position is set, else 0."""
    words = F.filter(bits, lambda w: w["word"] == pos // WORD)
    return F.when(F.size(words) > 0, F.call_function("shiftright", F.get(words, F.lit(0))["bits"], F.lit(pos % WORD)).bitwiseAND(F.lit(1))).otherwise(0).cast("int")


def bitmap_columns(df: DataFrame, values: list, prefix: str = "", bits: str = "bits") -> DataFrame:
    """A 0/1 column per value, where ``values`` holds the whole vocabulary by position. All are read from the bits of one row."""
    flags = [bitmap_flag(F.col(bits), pos).alias(f"{prefix}{value}") for pos, value in enumerate(values)]
    return df.select(*[c for c in df.columns if c != bits], *flags)


def bitmap_entries(bits: Column) -> Column:
    """The bits as ``array<struct<pos,n>>``, the layout of count vectors (``encoders.count_vectors``)."""
    return F.transform(bitmap_positions(bits), lambda p: F.struct(p.alias("pos"), F.lit(1).cast("bigint").alias("n")))
