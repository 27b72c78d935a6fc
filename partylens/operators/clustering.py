"""k-means, its quality and its explanation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partylens.functions.numbers import rounded
from partylens.operators.lloyd import Lloyd, fit_lloyd, on_grid
from partylens.session import stable

SEED = 1


def fit_kmeans(vectors: DataFrame, k: int, seed: int = SEED, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features).fit(vectors)


class HeldOutSilhouette(ClusteringEvaluator):
    """Silhouette, or NaN where all rows are in one cluster: Spark's own has no value for that and raises."""

    def _evaluate(self, dataset: DataFrame) -> float:
        if dataset.select(self.getPredictionCol()).distinct().limit(2).count() < 2:
            return float("nan")
        return super()._evaluate(dataset)


def fit_validated(
    vectors: DataFrame, k: int = 4, seed: int = SEED, features: str = "features", train_ratio: float = 0.75
) -> TrainValidationSplitModel:
    """k-means in a pipeline, rated on a held-out part by silhouette, then fitted on all rows.

    The rating is NaN where the held-out rows, of a very small table mostly, are all in one cluster.
    """
    kmeans = KMeans(k=k, seed=seed, featuresCol=features)
    search = TrainValidationSplit(
        estimator=Pipeline(stages=[kmeans]),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=HeldOutSilhouette(featuresCol=features),
        trainRatio=train_ratio,
        seed=seed,
    )
    return search.fit(vectors)


def silhouette(assigned: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(assigned)


def squared_distance(columns: list[str], center: list[float]) -> Column:
    terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, center)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def nearest_center(columns: list[str], centers: list[list[float]]) -> Column:
    """Number of the nearest given centre, the first of equals. A plain expression, no join."""
    distances = F.array(*[squared_distance(columns, center) for center in centers])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def cluster_sizes(assigned: DataFrame, prediction: str = "prediction") -> DataFrame:
    return assigned.groupBy(prediction).agg(F.count(F.lit(1)).alias("n")).orderBy("n", prediction)


def spread(vectors: DataFrame, features: str = "features") -> float:
    """Squared distances to the common mean: the cost of a single cluster."""
    row = vectors.select(Summarizer.metrics("variance", "count").summary(F.col(features)).alias("s")).first()
    return float(sum(row.s.variance) * max(row.s["count"] - 1, 0))


def elbow(vectors: DataFrame, ks: range | list[int] = range(1, 16), features: str = "features") -> DataFrame:
    """Cost per number of clusters, all in the same passes. Give a written table."""
    points, scale, width = on_grid(vectors, features)
    found = fit_lloyd(points, [k for k in ks if k > 1], scale, width)
    return costs(vectors, found, ks, features)


def costs(vectors: DataFrame, found: Lloyd, ks: range | list[int], features: str = "features") -> DataFrame:
    """``(k, cost)`` of a fit; a single cluster needs none."""
    rows = [(k, spread(vectors, features) if k == 1 else found.cost(k)) for k in ks]
    return vectors.sparkSession.createDataFrame(rows, "k int, cost double")


def explain_each(
    rows: DataFrame, numeric: list[str], category: str | None = None, clusters: str = "predictions", ks: list[int] | None = None
) -> DataFrame:
    """Correlation of each cluster's 0/1 flag with each feature, for several clusterings of the same rows: ``(k, feature, cluster, r)``.

    ``clusters`` is an array with the row's cluster in each clustering, ``ks`` their names. All comes from one
    aggregate over one scan: per clustering, cluster and value of ``category`` the rows and, per number, count, mean and
    variance. Everything else is merged from these cells: clusters, values and the whole table. With a 0/1 flag of share p
    Pearson's r is (mean inside - mean) / deviation * sqrt(p / (1 - p)). A row without a number is left out of that number's share
    and means; each value of ``category`` counts as a 0/1 feature; a row without cluster or value has no flag set. What does
    not vary has no r.
    """
    cells = (
        rows.select(F.posexplode(clusters).alias("_at", "cluster"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(numeric)],
                    (F.col(category) if category else F.lit(None).cast("string")).alias("_value"))
        .groupBy("_at", "cluster", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"), *[
            F.struct(F.count(f"_x{i}").alias("n"), F.avg(f"_x{i}").cast("double").alias("mean"), F.var_pop(f"_x{i}").cast("double").alias("var")).alias(f"_x{i}")
            for i in range(len(numeric))])
    )
    # Written, so that there is one scan and one aggregate; cells are as many as clusters times values.
    cells = stable(cells, "cells")
    listed = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"_x{i}")[m].alias(m) for m in ("n", "mean", "var")]) for i, c in enumerate(numeric)])
    parts = []
    if numeric:
        parts.append(_number_r(cells.select("_at", "cluster", F.inline(listed))))
    if category:
        parts.append(_value_r(cells))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if ks is not None:
        out = out.withColumn("k", F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("_at") + 1))
    named = out.where(F.col("cluster").isNotNull())
    return named.select(*(["k"] if ks is not None else []), "feature", "cluster", rounded(F.col("r")).alias("r"))


def _number_r(cells: DataFrame) -> DataFrame:
    """Cells merged to clusters, clusters to the whole table: what lies between the parts is added to what lies within them."""
    n, mean, var = F.col("n"), F.coalesce("mean", F.lit(0.0)), F.coalesce("var", F.lit(0.0))
    inside = cells.groupBy("_at", "cluster", "feature").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(n * mean), F.sum("n")).alias("mean"), F.sum(n * var).alias("_within"),
        F.collect_list(F.struct(n.alias("n"), mean.alias("mean"))).alias("_cells"))
    between = F.aggregate("_cells", F.lit(0.0), lambda s, c: s + c["n"] * (c["mean"] - F.col("mean")) * (c["mean"] - F.col("mean")))
    inside = inside.select("_at", "cluster", "feature", "n", "mean", F.try_divide(F.col("_within") + F.coalesce(between, F.lit(0.0)), n).alias("var"))
    table = Window.partitionBy("_at", "feature")
    every = inside.withColumn("_n", F.sum("n").over(table)).withColumn("_mean", F.try_divide(F.sum(n * mean).over(table), F.col("_n")))
    off = mean - F.col("_mean")
    every = every.withColumn("_dev", F.sqrt(F.try_divide(F.sum(n * (var + off * off)).over(table), F.col("_n"))))
    odds = F.sqrt(F.try_divide(n, F.col("_n") - n))
    varies = F.col("_dev") > F.abs("_mean") * 1e-13  # less is rounding of the means
    r = F.when(varies, (F.col("mean") - F.col("_mean")) / F.col("_dev")) * odds
    return every.select("_at", "cluster", "feature", r.alias("r"))


def _value_r(cells: DataFrame) -> DataFrame:
    """r of two flags from the counts of both, of each and of all."""
    both = cells.where(F.col("_value").isNotNull()).select("_at", "cluster", F.col("_value").alias("feature"), F.col("_rows").alias("both"))
    by_value = both.groupBy("_at", "feature").agg(F.sum("both").alias("n_v"))
    by_cluster = cells.groupBy("_at", "cluster").agg(F.sum("_rows").alias("n_c"))
    # Clusters are few and fixed by k, so each value meets each cluster as a list entry.
    clusters = by_cluster.groupBy("_at").agg(F.collect_list(F.struct("cluster", "n_c")).alias("_clusters"), F.sum("n_c").cast("double").alias("n"))
    grid = by_value.join(F.broadcast(clusters), "_at").select("_at", "feature", "n_v", "n", F.inline("_clusters"))
    n, n_c, n_v, met = F.col("n"), F.col("n_c"), F.col("n_v"), F.coalesce(F.col("both"), F.lit(0))
    r = F.try_divide(n * met - n_c * n_v, F.sqrt(n_c * (n - n_c)) * F.sqrt(n_v * (n - n_v)))
    return grid.join(both, ["_at", "cluster", "feature"], "left").select("_at", "cluster", "feature", r.alias("r"))


def explain_clusters(
    assigned: DataFrame, numeric: list[str], category: str | None = None, cluster: str = "prediction"
) -> DataFrame:
    """``explain_each`` for one clustering: ``(feature, cluster, r)``. ``cluster`` may be a column of texts."""
    named = dict(assigned.dtypes)[cluster] == "string"
    label = F.col(cluster) if named else F.col(cluster).cast("int")
    return explain_each(assigned.withColumn("_clusters", F.array(label)), numeric, category, "_clusters")


def sweep(
    vectors: DataFrame, ks: list[int], numeric: list[str], category: str | None = None, features: str = "features"
) -> DataFrame:
    """Cluster explanation for several ``k``: ``(k, feature, cluster, r)``. Give a written table."""
    points, scale, width = on_grid(vectors, features)
    found = fit_lloyd(points, ks, scale, width)
    return explain_each(found.assigned(points, ks), numeric, category, ks=ks)
