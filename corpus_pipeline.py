"""From raw documents to sharded training data, one operator of ``partylens.llm`` per stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last
return the columns of ``docs``, whatever their names. Every stage decides by row, with or without an id of its
own: rows that repeat an id go or stay each by its own text. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partylens.llm import decontaminate, jaccard, mixing, sharding, toxicity
from partylens.llm.queries import SHARDS, fold, levels, table
from partylens.session import stable

REJECT = 0.5  # toxicity score from which a document goes
BUDGET = 0.9  # tokens to keep of what reaches the mix


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weak supervision learns from labels outside the held-out fold; documents from ``REJECT`` on go. A null text stays."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(docs.where(fold(F.col("doc_id"), 5) != 0), labels)
    mark = unused("_toxicity", docs)
    return toxicity.score(docs, model, mark).where(F.col(mark) < REJECT).select(*docs.columns)


def unused(name: str, docs: DataFrame) -> str:
    """``name``, or a longer one that no column of ``docs`` has (upper and lower case are one)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a written number, by which a stage decides on each row, and the name of its column."""
    row = unused("_row", docs)
    return stable(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one stays: that with the smallest id (no id is last), of such rows the first written."""
    rows, row = numbered(docs)
    found = jaccard.near_duplicates(rows, row).select(F.col("doc_id").alias("at"), "component_id")
    placed = rows.select(F.col(row).alias("at"), F.col("doc_id").alias("id")).join(found, "at")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))["at"].alias("first"))
    copies = placed.join(first, "component_id").where(F.col("at") != F.col("first")).select(F.col("at").alias(row))
    return rows.join(copies, row, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a window of a benchmark item go."""
    rows, row = numbered(docs)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), row)
    return rows.join(found.where(F.col("n_hit") > 0).select(F.col("doc_id").alias(row)), row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal weights through domain, language and source, each row once at most."""
    used = mixing.mixed(docs, levels(), budget=BUDGET, epochs=1, seed="mix", carry=docs.columns).where(F.col("copies") > 0)
    return used.select(*[F.col(f"_carried_{c}").alias(c) for c in docs.columns])


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    return sharding.shard_rows(docs, [1.0] * SHARDS, carry=docs.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

ORACLE_SQL = None  # a learned stage has no SQL; the tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stable(stage(spark, docs, sf_dir), name)
    return docs
