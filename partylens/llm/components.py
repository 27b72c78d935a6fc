"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.session import stable


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``links`` (a, b).

    Rounds of large-star and small-star: every node ties its larger, then its smaller neighbours to the
    smallest one near it, until nothing changes. A round is two partial aggregations and joins on the node;
    adaptive execution splits the joins of a node with very many links. Each round is written to the shared
    folder, so lineage stays short. Links with a null end and links to oneself say nothing.
    """
    edges = stable(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").where(F.col("b") > F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = stable(small.where(F.col("a") != F.col("b")).distinct(), "links")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
