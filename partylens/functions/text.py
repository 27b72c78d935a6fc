"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partylens.functions.numbers import number

# The head-count unit in size bands, and the text a missing value turns into.
HEADCOUNT_UNIT = "fő"
MISSING_TEXT = "nan"


def as_text(value: Column) -> Column:
    """Any value as text; null becomes the word for missing values."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_TEXT))


def without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def part(text: Column, separator: str, position: int) -> Column:
    """The ``position``-th piece (from 0) of a split text; null when there is none."""
    return F.get(F.split(text, _literal(separator)), F.lit(position))


def _literal(separator: str) -> str:
    """``split`` takes a regular expression; quote the separator."""
    return "\\Q" + separator + "\\E"


def words(*columns: Column) -> Column:
    """Values joined by blanks; null as soon as one of them is null."""
    pieces: list[Column] = []
    for column in columns:
        pieces += [F.lit(" "), column.cast("string")]
    return F.concat(*pieces[1:])


def without_list_marks(text: Column) -> Column:
    """Drop square brackets and double quotes."""
    return F.translate(text, '["]', "")


def size_band(text: Column, mode: str = "compat") -> Column:
    """Head-count band to its upper bound: ``10-19 fő`` gives 19.

    ``compat`` turns everything without an upper bound into 1, also ``250+ fő``;
    ``lower_bound`` uses the first number of the text there.
    """
    cleaned = without(as_text(text), HEADCOUNT_UNIT)
    upper = number(part(cleaned, "-", 1), "int")
    if mode == "compat":
        return F.coalesce(upper, F.lit(1))
    if mode == "lower_bound":
        first = number(F.regexp_extract(cleaned, r"(\d+)", 1), "int")
        return F.coalesce(upper, first, F.lit(1))
    raise ValueError(f"unknown mode {mode!r}")
