"""Customer clusters: train on the combined table, report, score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.operators.clustering import SEED, cluster_sizes, fit_kmeans, fit_validated, silhouette
from partylens.operators.encoders import assembled, complete
from partylens.plans.features import training_columns, training_rows
from partylens.schemas import FEATURE_COLUMNS
from partylens.session import stable


@dataclass
class CustomerClusters:
    """Fitted model, its training rows with clusters, and how many rows had gaps."""

    model: TrainValidationSplitModel
    assigned: DataFrame
    columns: list[str]
    skipped: int

    def silhouette(self) -> float:
        return silhouette(self.assigned)


def feature_order(columns: list[str]) -> list[str]:
    """The one order in which training and scoring put features into a vector; further columns come after."""
    return [c for c in FEATURE_COLUMNS if c in columns] + [c for c in columns if c not in FEATURE_COLUMNS]


def train_clusters(
    combined: DataFrame, k: int = 4, seed: int = SEED, include_ids: bool = False,
    columns: list[str] | None = None,
) -> CustomerClusters:
    """k-means over the numeric features, rows with gaps left out and counted.

    The rows are written first, so the many passes of the fit do not repeat the joins.
    """
    rows = stable(training_rows(combined, include_ids), "training")
    columns = columns or feature_order(training_columns(rows, include_ids))
    skipped = rows.agg(F.count_if(~complete(columns))).first()[0]
    vectors = assembled(rows, columns, invalid="skip")
    model = fit_validated(vectors, k, seed)
    return CustomerClusters(model, model.transform(vectors), columns, skipped)


def save_model(clusters: CustomerClusters, path: str) -> None:
    clusters.model.bestModel.write().overwrite().save(path)


def size_report(rows: DataFrame, columns: list[str], k: int = 2, seed: int = SEED) -> DataFrame:
    """Cluster sizes of k-means over a few columns."""
    vectors = stable(assembled(rows.select(*columns), columns, invalid="skip").select("features"), "vectors")
    return cluster_sizes(fit_kmeans(vectors, k, seed).transform(vectors))
