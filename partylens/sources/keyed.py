"""Tables with a key on plain Parquet: append is upsert, the last write wins.

A table is a folder of writes, ``writer=W/batch=N``; repeating a write replaces it and touches no other.
Every row carries a version, and reading keeps the newest row per key. Which write came later
plays no part, so several writers, restarts and repeats give the same table.

``merge`` folds all writes into one table in buckets by key, and a new pointer, written as a whole, makes it the base of all
later reads; they read the base and the writes since. Batches of a writer are taken to be written in the order of their
numbers, and writes that are merged are final: a repeat of one is not read.
``clean`` removes what the last pointer no longer needs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from partylens.schemas import TABLES, conform

VERSION = "_version"
_POINTER = "generation string, buckets int, merged array<struct<writer:string,upto:bigint>>"


def newest_rows(df: DataFrame, keys: tuple[str, ...], version: str = VERSION) -> DataFrame:
    """The row with the highest ``version`` per key; rows without a key go.

    Equal versions are told apart by the other columns, the highest wins; a null version is the oldest. An
    aggregate: the rows of a key are reduced before the shuffle, however many there are.
    """
    others = [c for c in df.columns if c not in (*keys, version)]
    newest = F.max(F.struct(version, *others)).alias("_newest")
    rows = df.dropna(subset=list(keys)).groupBy(*keys).agg(newest)
    return rows.select(*[F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in df.columns])


def _versioned(df: DataFrame, version: Column | str) -> DataFrame:
    return df.withColumn(VERSION, F.col(version) if isinstance(version, str) else version)


def upsert(df: DataFrame, path: str, keys: tuple[str, ...], version: Column | str,
           writer: str | None = None, batch: int = 0) -> None:
    """Add the rows of ``df``; a row replaces the stored one of its key if its ``version`` is higher.

    ``version`` must have one type in all writes of a table. ``writer`` and ``batch`` name the write:
    the same pair again replaces it. Without a writer, each call is a write of its own.
    """
    rows = newest_rows(_versioned(df, version), keys)
    rows.write.mode("overwrite").parquet(f"{path}/writer={writer or uuid.uuid4().hex}/batch={batch}")


def read_keyed(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """Newest row per key over all writes. The rows of a merged table are not shuffled, only those of the writes since."""
    pointer = _pointer(spark, path)
    return _read(spark, path, keys, pointer, _unmerged(spark, path, pointer)).drop(VERSION)


def _read(spark: SparkSession, path: str, keys: tuple[str, ...], pointer: Row | None, folders: list[str]) -> DataFrame:
    recent = _writes(spark, path, folders)
    if pointer is None:
        if recent is None:
            # Spark's own error for a table without any complete write.
            recent = spark.read.parquet(f"{path}/writer=*/batch=*/_SUCCESS")
        return newest_rows(recent, keys)
    base = _base(spark, pointer, keys)
    if recent is None:
        return base
    recent = newest_rows(recent, keys)
    others = [c for c in base.columns if c not in (*keys, VERSION)]

    def packed(df: DataFrame, out: str) -> DataFrame:
        return df.select(*keys, F.struct(VERSION, *others).alias(out))

    # The struct of the side that has none is null, which greatest passes over.
    both = packed(base, "_stored").join(packed(recent, "_added"), list(keys), "full_outer").withColumn("_newest", F.greatest("_stored", "_added"))
    return both.select(*[F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in base.columns])


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    system, where = _files(spark, pattern)
    return sorted(str(found.getPath()) for found in system.globStatus(where) or [])


def _pointer(spark: SparkSession, path: str) -> Row | None:
    """The last complete pointer: number, generation, buckets, and up to which batch each writer is merged."""
    done = _listed(spark, f"{path}/_merged/pointers/number=*/_SUCCESS")
    if not done:
        return None
    newest = max((f.rsplit("/", 1)[0] for f in done), key=lambda f: int(f.rsplit("=", 1)[1]))
    return spark.read.schema(_POINTER).json(newest).withColumn("number", F.lit(int(newest.rsplit("=", 1)[1]))).first()


def _unmerged(spark: SparkSession, path: str, pointer: Row | None) -> list[str]:
    """Folders of complete writes that the pointer does not cover."""
    merged = {w: upto for w, upto in pointer["merged"]} if pointer else {}
    done = [f.rsplit("/", 1)[0] for f in _listed(spark, f"{path}/writer=*/batch=*/_SUCCESS")]
    return [f for f in done if _batch(f)[1] > merged.get(_batch(f)[0], -1)]


def _writes(spark: SparkSession, path: str, folders: list[str]) -> DataFrame | None:
    return spark.read.option("basePath", path).parquet(*folders).drop("writer", "batch") if folders else None


def _batch(folder: str) -> tuple[str, int]:
    *_, writer, batch = folder.split("/")
    return writer.split("=", 1)[1], int(batch.split("=", 1)[1])


def _base(spark: SparkSession, pointer: Row, keys: tuple[str, ...]) -> DataFrame:
    """The merged table, known to the session's catalog so that its buckets are used."""
    name = f"merged_{pointer['generation'].rsplit('/', 1)[1]}"
    if not spark.catalog.tableExists(name):
        layout = spark.read.parquet(pointer["generation"]).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {pointer['buckets']} BUCKETS LOCATION '{pointer['generation']}'")
    return spark.table(name)


def merge(spark: SparkSession, path: str, keys: tuple[str, ...], buckets: int = 64) -> None:
    """Fold all writes into one table with a file per bucket and switch reads to it.

    Readers before the new pointer see the old state, readers after it the new one; a merge that dies leaves files that nobody
    reads. Two merges at once: the second pointer of a number fails, and its merge can be run again.
    """
    pointer = _pointer(spark, path)
    folders = _unmerged(spark, path, pointer)
    if not folders:
        return
    merged = dict(map(tuple, pointer["merged"])) if pointer else {}
    # A writer whose folders are cleaned needs no entry.
    here = {_batch(f)[0] for f in _listed(spark, f"{path}/writer=*/batch=*")}
    merged = {w: n for w, n in merged.items() if w in here}
    for writer, batch in map(_batch, folders):
        merged[writer] = max(batch, merged.get(writer, -1))
    generation = f"{path}/_merged/generations/{uuid.uuid4().hex}"
    rows = _read(spark, path, keys, pointer, folders).repartition(buckets, *keys)
    name = f"merged_{generation.rsplit('/', 1)[1]}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", generation).format("parquet").saveAsTable(name)
    number = pointer["number"] + 1 if pointer else 0
    row = spark.createDataFrame([(generation, buckets, list(merged.items()))], _POINTER)
    row.coalesce(1).write.mode("error").json(f"{path}/_merged/pointers/number={number}")


def clean(spark: SparkSession, path: str) -> None:
    """Remove the writes, generations and pointers that the last pointer replaces. Only when no reader is at work on an older state."""
    pointer = _pointer(spark, path)
    if pointer is None:
        return
    merged = dict(map(tuple, pointer["merged"]))
    generation = pointer["generation"].rsplit("/", 1)[1]
    old = [f for f in _listed(spark, f"{path}/writer=*/batch=*") if _batch(f)[1] <= merged.get(_batch(f)[0], -1)]
    old += [f for f in _listed(spark, f"{path}/_merged/generations/*") if not f.endswith(generation)]
    old += [f for f in _listed(spark, f"{path}/_merged/pointers/number=*") if int(f.rsplit("=", 1)[1]) < pointer["number"]]
    for folder in old:
        system, where = _files(spark, folder)
        system.delete(where, True)


def write_table(df: DataFrame, root: str, table: str, version: Column | str,
                writer: str | None = None, batch: int = 0) -> None:
    """Upsert into a declared table: columns and key come from its declaration.

    ``version`` may use columns of ``df`` that the table lacks. A job that replaces whole rows can take
    its start time.
    """
    _, keys = TABLES[table]
    rows = conform(_versioned(df, version), table, keep=[VERSION])
    upsert(rows, f"{root}/{table}", keys, VERSION, writer, batch)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_keyed(spark, f"{root}/{table}", TABLES[table][1])


def load_table(spark: SparkSession, table: str, fmt: str | None = None, **options: str) -> DataFrame:
    """Table of any installed connector (``fmt`` with its options) or of the session catalog."""
    if fmt is None:
        return spark.table(table)
    return spark.read.format(fmt).options(table=table, **options).load()


def save_table(df: DataFrame, table: str, fmt: str, **options: str) -> None:
    """Append through an installed connector; a keyed store then upserts by itself."""
    df.write.format(fmt).mode("append").options(table=table, **options).save()


def predictions_by_features(predictions: DataFrame) -> DataFrame:
    """Predictions in the layout keyed by the feature text: equal features make one row."""
    return predictions.groupBy("features").agg(F.max("prediction").alias("prediction"))
