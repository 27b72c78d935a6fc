"""Pairwise-complete co-moments of any number of columns in one pass.

A task keeps, per pair of column blocks, counts, means, squared deviations and products over the rows where both
columns are known, and gives one row per pair of blocks at its end. Rows of the same blocks are merged as co-moments are
(what lies between the parts is added to what lies within them), first in slots, then together, so no task holds
the blocks of all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64  # columns of a block
SLOTS = 64  # first merges per pair of blocks
ROUNDING = 1e-10  # deviations below this share of the mean are rounding
_PARTS = ("n", "mean_a", "mean_b", "m_a", "m_b", "c")
_SCHEMA = "i int, j int, slot int, " + ", ".join(f"{p} binary" for p in _PARTS)


def _moments(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """n, both means, both sums of squared deviations and the co-moment of every column of x with every one of y, NaN unknown."""
    kx, ky = (~np.isnan(x)).astype(np.float64), (~np.isnan(y)).astype(np.float64)
    # Moved by a value of the batch, so that large means do not swallow small deviations.
    middle = [np.nan_to_num(np.array([c[~np.isnan(c)][0] if (~np.isnan(c)).any() else 0.0 for c in z.T])) for z in (x, y)]
    x0, y0 = np.nan_to_num(x - middle[0]), np.nan_to_num(y - middle[1])
    n = kx.T @ ky
    safe = np.maximum(n, 1)
    sx, sy = x0.T @ ky, kx.T @ y0
    return [n, np.where(n > 0, sx / safe + middle[0][:, None], 0.0), np.where(n > 0, sy / safe + middle[1][None, :], 0.0),
            (x0 * x0).T @ ky - sx * sx / safe, kx.T @ (y0 * y0) - sy * sy / safe, x0.T @ y0 - sx * sy / safe]


def _joined(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    share = b[0] / safe
    da, db = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    # A side without rows has mean 0 and takes no part.
    da, db = np.where((a[0] > 0) & (b[0] > 0), da, 0.0), np.where((a[0] > 0) & (b[0] > 0), db, 0.0)
    mean_a = np.where(a[0] > 0, a[1] + da * share, b[1])
    mean_b = np.where(a[0] > 0, a[2] + db * share, b[2])
    return [n, mean_a, mean_b, a[3] + b[3] + da * da * weight, a[4] + b[4] + db * db * weight, a[5] + b[5] + da * db * weight]


def _gathered(width: int, block: int, slots: int):
    blocks = [(i, min(i + block, width)) for i in range(0, width, block)]

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
            for i, (a, z) in enumerate(blocks):
                for j, (b, y) in enumerate(blocks[i:], i):
                    one = _moments(x[:, a:z], x[:, b:y])
                    held[i, j] = _joined(held[i, j], one) if (i, j) in held else one
        slot = TaskContext.get().partitionId() % slots
        yield pa.RecordBatch.from_pylist([
            {"i": i, "j": j, "slot": slot, **{p: v.tobytes() for p, v in zip(_PARTS, parts)}} for (i, j), parts in held.items()
        ], pa.schema([(n, pa.int32()) for n in ("i", "j", "slot")] + [(p, pa.binary()) for p in _PARTS]))

    return gathered


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    held = None
    for row in rows[list(_PARTS)].itertuples(index=False):
        if row.n:
            one = [np.frombuffer(v, np.float64) for v in row]
            held = one if held is None else _joined(held, one)
    first = rows.iloc[0]
    return pd.DataFrame([{"i": first.i, "j": first.j, "slot": first.slot, **{p: v.tobytes() for p, v in zip(_PARTS, held or [np.zeros(0)] * 6)}}])


def _listed(columns: list[str], block: int):
    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                a, b = columns[row.i * block:(row.i + 1) * block], columns[row.j * block:(row.j + 1) * block]
                n, mean_a, mean_b, m_a, m_b, c = [
                    np.frombuffer(v, np.float64).reshape(len(a), len(b)) if v else np.zeros((len(a), len(b))) for v in (getattr(row, p) for p in _PARTS)]
                m_a, m_b = [np.where(m > n * (mean * ROUNDING) ** 2, m, 0.0) for m, mean in ((m_a, mean_a), (m_b, mean_b))]
                keep = np.ones(n.shape, bool) if row.i < row.j else np.triu(np.ones(n.shape, bool))
                x, y = np.nonzero(keep)
                yield pd.DataFrame({"a": np.array(a, object)[x], "b": np.array(b, object)[y], "n": n[keep].astype(np.int64),
                                    "m_a": m_a[keep], "m_b": m_b[keep], "c": c[keep]})

    return listed


def co_moments(df: DataFrame, columns: list[str], block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """``(a, b, n, m_a, m_b, c)`` for every pair a <= b in the order of ``columns``: rows where both are known, the sums of squared
    deviations of a and of b over these rows, and of the products of both deviations. Null and NaN are unknown; a pair that is never
    known together has n = 0, and so has every pair of an empty table."""
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = numbers.mapInArrow(_gathered(len(columns), block, slots), _SCHEMA)
    count = -(-len(columns) // block)
    parts = parts.unionByName(df.sparkSession.createDataFrame([(i, j, 0, *[b""] * len(_PARTS)) for i in range(count) for j in range(i, count)], _SCHEMA))
    for keys in (["i", "j", "slot"], ["i", "j"]):
        parts = parts.groupBy(*keys).applyInPandas(_merged, _SCHEMA)
    return parts.mapInPandas(_listed(columns, block), "a string, b string, n bigint, m_a double, m_b double, c double")
