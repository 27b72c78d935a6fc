"""ML vectors as text or arrays, and lines of numbers as vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_text(vector: Column) -> Column:
    """Vector as a JSON list, the same for dense and sparse vectors."""
    return F.to_json(vector_to_array(vector))


def sparse_text(size: Column, entries: Column) -> Column:
    """Text ``(size,[positions],[values])`` from sorted ``array<struct<pos,n>>``."""
    positions = F.array_join(F.transform(entries, lambda e: e["pos"].cast("string")), ",")
    values = F.array_join(F.transform(entries, lambda e: e["n"].cast("double").cast("string")), ",")
    return F.concat(
        F.lit("("), size.cast("string"), F.lit(",["), positions, F.lit("],["), values, F.lit("])")
    )


def line_vector(line: Column) -> Column:
    """Comma-separated numbers to a dense vector, without the last field.

    A field that is no number counts as NaN, so the assembler's invalid-row rule sees it.
    """
    fields = F.split(line, ",")
    kept = F.slice(fields, F.lit(1), F.greatest(F.size(fields) - 1, F.lit(0)))
    numbers = F.transform(kept, lambda f: F.coalesce(F.trim(f).try_cast("double"), F.lit(float("nan"))))
    return array_to_vector(numbers)
