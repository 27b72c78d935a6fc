"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "partylens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every plan of this package relies on.

    Extra settings use ``__`` for the dots: ``build_session(spark__ui__enabled="false")``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Where that is unset they go below the warehouse, which all executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/partylens-stages").rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Lost executors then cost a re-read instead of a recomputation, later passes
    scan only the columns they need, and join sizes are known from the files.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
