"""k-means for many numbers of clusters at once, with the same result on every cluster and in every order of rows.

Vectors are put on a grid of whole numbers, so counts, sums and costs add up exactly, whichever task adds them. The
first centres are farthest points: the longest vector, then always the point farthest from those chosen, so the
first k of them start the fit for every k. A round is one pass over the points: the centres of all k are sent along,
and per k and cluster the count, the sum and the cost come back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 20
AT_ONCE = 32 << 20  # bytes of sums that the driver adds up itself


def grid_bits(width: int) -> int:
    """Bits of a component's size with which squared distances of ``width`` components stay below 2^62."""
    return (60 - math.ceil(math.log2(max(width, 1)))) // 2


def grid_scale(largest: float, width: int) -> float:
    """Steps of the grid per unit, a power of two: multiplying by it is exact."""
    return 2.0 ** (grid_bits(width) - (math.ceil(math.log2(largest)) if largest > 0 else 0))


def on_grid(vectors: DataFrame, features: str = "features", out: str = "_whole") -> tuple[DataFrame, float, int]:
    """``vectors`` with their components as whole numbers, the scale, and the width; one pass for the largest component."""
    numbers = vectors.withColumn(out, vector_to_array(features))
    largest, width = numbers.agg(
        F.max(F.array_max(F.transform(out, F.abs))), F.max(F.size(out))).first()
    scale = grid_scale(largest or 0.0, width or 0)
    return numbers.withColumn(out, F.transform(out, lambda x: F.floor(x * F.lit(scale)).cast("bigint"))), scale, width or 0


@dataclass
class Lloyd:
    """Centres per k as whole numbers of the grid, and the exact cost of each k in squared steps."""

    scale: float
    centers: dict[int, np.ndarray]
    steps: dict[int, int]

    def cost(self, k: int) -> float:
        return self.steps[k] / (self.scale * self.scale)

    def assigned(self, rows: DataFrame, ks: list[int], out: str = "predictions", whole: str = "_whole") -> DataFrame:
        """Rows with the cluster for each of ``ks``, as an array in that order."""
        chosen = [self.centers[k] for k in ks]

        def nearest(points: pd.Series) -> pd.Series:
            points = np.array(points.tolist(), np.int64).reshape(len(points), chosen[0].shape[1])
            found = np.stack([squared(points, c).argmin(axis=1) for c in chosen], axis=1)
            return pd.Series(list(found.astype(np.int32)))

        return rows.withColumn(out, F.pandas_udf(nearest, "array<int>")(F.col(whole)))


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances in whole numbers, all points to all centres."""
    out = np.zeros((len(points), len(centers)), np.int64)
    for j in range(points.shape[1]):
        out += (points[:, j, None] - centers[None, :, j]) ** 2
    return out


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _first_of(points: np.ndarray, away: np.ndarray) -> tuple[int, list[int]]:
    """The largest distance and the lowest point that has it."""
    most = away.max()
    ties = points[away == most]
    return int(most), ties[np.lexsort(ties.T[::-1])[0]].tolist() if ties.shape[1] else []


def farthest_points(points: DataFrame, width: int, count: int) -> np.ndarray:
    """Up to ``count`` different points (fewer if there are no more), one pass each. One row per task comes back."""
    chosen = np.zeros((0, width), np.int64)
    while len(chosen) < count:
        def farthest(batches: Iterator[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                here = _matrix(batch, width)
                away = squared(here, chosen).min(axis=1) if len(chosen) else (here * here).sum(axis=1)
                one = _first_of(here, away)
                if best is None or (-one[0], one[1]) < (-best[0], best[1]):
                    best = one
            if best is not None:
                yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.list_(pa.int64()))], names=["away", "point"])

        found = points.mapInArrow(farthest, "away bigint, point array<bigint>").orderBy(F.desc("away"), "point").limit(1).collect()
        if not found or (len(chosen) and found[0]["away"] == 0):
            break
        chosen = np.concatenate([chosen, np.array([found[0]["point"]], np.int64).reshape(1, width)])
    return chosen


def _sums(points: DataFrame, tasks: int, centers: dict[int, np.ndarray], width: int, at_once: int) -> dict[tuple[int, int], tuple[int, list[int], int]]:
    """Count, sum and cost of every cluster of every k, in one pass.

    A task gives one row: per centre the count, the sum and the cost in two halves, which do not overflow over the rows of
    a task. Up to ``at_once`` bytes of such rows are added up here; more are added by centre and component first.
    """
    ks = list(centers)
    every = np.concatenate([centers[k] for k in ks])
    bounds = np.cumsum([0, *[len(centers[k]) for k in ks]])
    fields = width + 3

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(every), fields), np.int64)
        for batch in batches:
            here = _matrix(batch, width)
            away = squared(here, every)
            one = np.concatenate([here, np.ones((len(here), 3), np.int64)], axis=1)
            for a, z in zip(bounds[:-1], bounds[1:]):
                to = a + away[:, a:z].argmin(axis=1)
                cost = away[np.arange(len(here)), to]
                one[:, width + 1], one[:, width + 2] = cost >> 32, cost & 0xFFFFFFFF
                np.add.at(total, to, one)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], names=["total"])

    partial = points.mapInArrow(summed, "total array<bigint>")
    every_sum = np.zeros(len(every) * fields, object)
    if tasks * len(every) * fields * 8 <= at_once:
        for row in partial.toArrow().column(0).chunks:
            for one in row.flatten().to_numpy().reshape(-1, len(every_sum)):
                every_sum += one
    else:
        cells = partial.select(F.posexplode("total").alias("at", "sum")).where(F.col("sum") != 0)
        # One row per centre and component, whatever the number of points and tasks.
        for at, total in cells.groupBy("at").agg(F.sum(F.col("sum").cast("decimal(20,0)"))).collect():
            every_sum[at] = int(total)
    table = every_sum.reshape(len(every), fields).tolist()
    names = [(k, j) for k in ks for j in range(len(centers[k]))]
    return {name: (row[width], row[:width], (row[width + 1] << 32) + row[width + 2]) for name, row in zip(names, table) if row[width]}


def fit_lloyd(points: DataFrame, ks: list[int], scale: float, width: int, whole: str = "_whole", rounds: int = ROUNDS, at_once: int = AT_ONCE) -> Lloyd:
    """Centres for all ``ks`` after up to ``rounds`` rounds each; a k whose centres no longer move takes no part in further rounds.

    A centre is its points' mean, rounded down to the grid; one without points stays. Of equal distances the first centre
    counts. With fewer different points than k there are as many centres as points. ``points`` comes from ``on_grid``; the driver
    holds centres only.
    """
    points = points.select(whole).persist()
    try:
        tasks = points.rdd.getNumPartitions()
        seeds = farthest_points(points, width, max(ks, default=0))
        centers = {k: seeds[:k] for k in ks}
        steps: dict[int, int] = {k: 0 for k in ks}
        moving = {k: c for k, c in centers.items() if len(c)}
        for left in range(rounds, -1, -1):
            if not moving:
                break
            found = _sums(points, tasks, moving, width, at_once)
            for k, old in list(moving.items()):
                steps[k] = sum(found[k, j][2] for j in range(len(old)) if (k, j) in found)
                new = np.array([[s // found[k, j][0] for s in found[k, j][1]] if (k, j) in found else old[j] for j in range(len(old))], np.int64).reshape(old.shape)
                if (new == old).all() or not left:
                    del moving[k]
                else:
                    moving[k] = centers[k] = new
    finally:
        points.unpersist()
    return Lloyd(scale, centers, steps)
