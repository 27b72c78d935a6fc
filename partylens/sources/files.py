"""CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partylens.operators.columns import canonical_name

# Header texts an unnamed row-number column can have.
ROW_NUMBER_NAMES = ("unnamed: 0", "_c0", "")


def _names(header: list[str | None]) -> dict[str, int]:
    """Canonical column names and their positions; of a repeated header the first column counts.

    A copy is spelled like its original or with the ending ``.1`` that some writers add.
    """
    found: dict[str, int] = {}
    for at, text in enumerate(header):
        name = canonical_name(text or "")
        if at == 0 and name in ROW_NUMBER_NAMES:
            name = "index"
        name = name or f"_c{at}"
        if name not in found and not (name.endswith(".1") and name[:-2] in found):
            found[name] = at
    return found


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with header, columns found by their canonical names, not by position.

    An unnamed first column is the row number ``index``; repeated headers give one column. With ``schema`` the
    result has its columns, in its order; texts that do not fit their type become null, and a column
    that the file lacks is an error. Without it all columns are text, or guessed (``infer``, an extra pass).
    """
    first = spark.read.csv(path).first()
    header = list(first) if first else []
    names = _names(header)
    if schema is not None:
        missing = [f.name for f in schema if f.name not in names]
        if missing:
            raise ValueError(f"{path} has no columns {missing}")
    reader = spark.read.option("header", True)
    if infer and schema is None:
        raw = reader.option("inferSchema", True).csv(path)
        raw = raw.toDF(*[f"c{at}" for at in range(len(raw.columns))])
    else:
        texts = T.StructType([T.StructField(f"c{at}", T.StringType()) for at in range(len(header))])
        raw = reader.schema(texts).option("enforceSchema", True).csv(path)
    if schema is None:
        return raw.select(*[F.col(f"c{at}").alias(name) for name, at in names.items()])
    return raw.select(*[F.col(f"c{names[f.name]}").try_cast(f.dataType).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header, one file per partition, written by the executors."""
    df.write.mode(mode).option("header", True).csv(path)
