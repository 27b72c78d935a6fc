"""Codes of vectors: one of ``entries`` codebook entries per part, by Lloyd rounds over cover trees.

The rows of a task are cut into chunks, and every part of a chunk gets a cover tree: a node is a point with all points
within its radius, its children lie within that radius divided by ``SHRINK`` of centres that are farther apart
than that. Points stand in the order of the tree, so a subtree is a slice, and its count and sum are differences of
cumulative sums. The trees are written once; each round reads them. From the root down, an entry that cannot be
nearest to any point of a node by the triangle inequality is left out; a node with one entry left goes to it as a whole, the
points of a leaf with several are compared exactly, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.session import stable

CHUNK = 2048  # rows of a tree
LEAF = 16  # points that are not divided further
SHRINK = 1.3
LARGEST = 1 << 27  # components beyond it, either way, are set to it: sums and squared distances stay whole numbers of 64 bits
_EXACT = 1 << 21  # up to here floating point sums of squares are exact
_TREE = "order binary, points binary, start binary, end binary, center binary, radius binary, first binary"


@dataclass
class Tree:
    """Nodes in breadth-first order; the children of node i are ``first[i]`` to ``first[i + 1] - 1``."""

    order: np.ndarray  # row of each point
    points: np.ndarray  # in tree order
    start: np.ndarray
    end: np.ndarray
    center: np.ndarray  # place of the node's point in tree order
    radius: np.ndarray
    first: np.ndarray

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(value).tobytes() for name, value in vars(self).items()}

    @staticmethod
    def unpacked(row: dict[str, bytes], width: int) -> Tree:
        kinds = {"points": np.int32, "radius": np.float64}
        made = {name: np.frombuffer(value, kinds.get(name, np.int32)) for name, value in row.items()}
        made["points"] = made["points"].reshape(len(made["order"]), width).astype(np.int64)
        return Tree(**made)


def cover_tree(points: np.ndarray, leaf: int = LEAF, shrink: float = SHRINK) -> Tree:
    x = points.astype(np.float64)
    order = np.zeros(len(x), np.int64)
    nodes: list[tuple[int, int, int, float, int]] = []  # start, end, row of the centre, radius, parent
    filled = 0

    def distances(rows: np.ndarray, center: int) -> np.ndarray:
        away = x[rows] - x[center]
        return np.sqrt(np.einsum("ij,ij->i", away, away))

    rows = np.arange(len(x))
    todo = [(rows, 0, distances(rows, 0), -1)] if len(x) else []
    while todo:
        rows, center, away, parent = todo.pop()
        radius, number = float(away.max()), len(nodes)
        nodes.append((filled, filled + len(rows), center, radius, parent))
        if len(rows) <= leaf or radius == 0:
            order[filled:filled + len(rows)] = rows
            filled += len(rows)
            continue
        within = radius / shrink
        near = away <= within
        todo.append((rows[near], center, away[near], number))
        rows = rows[~near]
        while len(rows):
            away = distances(rows, int(rows[0]))
            near = away <= within
            todo.append((rows[near], int(rows[0]), away[near], number))
            rows = rows[~near]
    # A node comes right before its subtree; breadth-first order puts the children of a node side by side.
    start, end, center, radius, parent = (np.array(c) for c in zip(*nodes)) if nodes else (np.zeros(0, np.int64),) * 5
    depth = np.zeros(len(nodes), np.int64)
    for i in range(1, len(nodes)):
        depth[i] = depth[parent[i]] + 1
    by = np.lexsort((start, depth)) if len(nodes) else np.zeros(0, np.int64)
    at = np.zeros(len(nodes), np.int64)
    at[by] = np.arange(len(nodes))
    parents = at[parent[by][1:]] if len(nodes) else by
    first = np.searchsorted(parents, np.arange(len(nodes) + 1)) + 1
    place = np.zeros(len(x), np.int64)
    place[order] = np.arange(len(x))
    small = np.int32
    return Tree(order.astype(small), points[order].astype(small), start[by].astype(small), end[by].astype(small),
                (place[center[by]] if len(nodes) else by).astype(small), radius[by].astype(np.float64), first.astype(small))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``, whole numbers below 2^62."""
    a, b = a.astype(np.int64, copy=False), b.astype(np.int64, copy=False)
    most = int(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)))
    if most * most * 4 * max(a.shape[1], 1) < 1 << 52 and most < _EXACT:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole nodes with their entry, and single points (places in tree order) with theirs."""
    whole, whole_to, single, single_to = [], [], [], []
    node = np.zeros(min(1, len(tree.start)), np.int64)
    left = np.ones((len(node), len(entries)), bool)
    while len(node):
        away = np.where(left, np.sqrt(squared(tree.points[tree.center[node]], entries).astype(np.float64)), np.inf)
        best, radius = away.min(axis=1), tree.radius[node]
        # An entry stays if it may be as near as the best one somewhere in the ball; the slack is for rounding.
        reach = (best + 2 * radius) * (1 + 1e-9)
        left &= away <= reach[:, None]
        sure = left.sum(axis=1) == 1
        whole.append(node[sure])
        whole_to.append(left[sure].argmax(axis=1))
        node, left = node[~sure], left[~sure]
        children = (tree.first[node + 1] - tree.first[node]).astype(np.int64)
        ends = children == 0
        at, n = tree.start[node[ends]], (tree.end - tree.start)[node[ends]].astype(np.int64)
        if n.sum():
            place = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
            exact = np.where(np.repeat(left[ends], n, axis=0), squared(tree.points[place], entries), np.iinfo(np.int64).max)
            single.append(place)
            single_to.append(exact.argmin(axis=1))
        node, left, children = node[~ends], left[~ends], children[~ends]
        left = np.repeat(left, children, axis=0)
        node = np.repeat(tree.first[node] - (np.cumsum(children) - children), children) + np.arange(children.sum())
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (whole, whole_to, single, single_to))


def _whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(scale * vectors), -LARGEST, LARGEST).astype(np.int64)


def _matrix(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """Whole numbers, a row per vector; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), dims), np.int64)
    out[np.arange(dims)[None, :] < n[:, None]] = _whole(flat, scale)
    return out


def _grown(parts: int, dims: int, scale: float, chunk: int):
    width = dims // parts

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                rows = batch.slice(at, chunk)
                whole = _matrix(rows.column(rows.schema.get_field_index("_vector")), dims, scale)
                trees = [cover_tree(whole[:, p * width:(p + 1) * width]).packed() for p in range(parts)]
                kept = rows.select([n for n in rows.schema.names if n != "_vector"]).to_struct_array()
                rows_of = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
                yield pa.RecordBatch.from_arrays([rows_of, pa.array([trees], pa.list_(pa.struct([(f.split()[0], pa.binary()) for f in _TREE.split(", ")])))], names=["rows", "trees"])

    return grown


def _summed(codebooks: list[np.ndarray]):
    """Count and sum of the points of each entry, one row per part and entry that a task has met."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(c), np.int64) for c in codebooks]
        total = [np.zeros(c.shape, np.int64) for c in codebooks]
        for batch in batches:
            for i in range(batch.num_rows):
                for p, packed in enumerate(batch.column(0)[i].as_py()):
                    tree = Tree.unpacked(packed, codebooks[p].shape[1])
                    node, node_to, point, point_to = assign(tree, codebooks[p])
                    upto = np.concatenate([np.zeros((1, tree.points.shape[1]), np.int64), np.cumsum(tree.points, axis=0)])
                    np.add.at(count[p], node_to, tree.end[node].astype(np.int64) - tree.start[node])
                    np.add.at(total[p], node_to, upto[tree.end[node]] - upto[tree.start[node]])
                    np.add.at(count[p], point_to, 1)
                    np.add.at(total[p], point_to, tree.points[point])
        rows = [(p, e, int(count[p][e]), total[p][e].tolist()) for p in range(len(codebooks)) for e in np.flatnonzero(count[p]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=["part", "entry", "n", "total"])

    return summed


def _coded(codebooks: list[np.ndarray]):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = pa.RecordBatch.from_struct_array(batch.column(0).slice(i, 1).flatten())
                code, error = np.zeros((rows.num_rows, len(codebooks)), np.int64), np.zeros(rows.num_rows, np.int64)
                for p, packed in enumerate(batch.column(1)[i].as_py()):
                    tree = Tree.unpacked(packed, codebooks[p].shape[1])
                    node, node_to, point, point_to = assign(tree, codebooks[p])
                    to = np.zeros(len(tree.order), np.int64)
                    n = tree.end[node].astype(np.int64) - tree.start[node]
                    to[np.repeat(tree.start[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = np.repeat(node_to, n)
                    to[point] = point_to
                    code[tree.order, p] = to
                    error[tree.order] += ((tree.points - codebooks[p][to]) ** 2).sum(axis=1)
                digits = max(2, max((len(f"{len(c) - 1:x}") for c in codebooks), default=2))
                text = ["".join(f"{c:0{digits}x}" for c in row) for row in code.tolist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(text, pa.string()), pa.array(error)], names=[*rows.schema.names, "code", "error"])

    return coded


@dataclass
class Compressed:
    """``rows``: id, code, error and the columns to keep; ``codebooks``: entries by part, each a row of whole numbers."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def spelled(self) -> str:
        return ",".join(str(v) for book in self.codebooks for entry in book.tolist() for v in entry)


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: dict[str, str] | None = None,
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0, chunk: int = CHUNK,
) -> Compressed:
    """Codebooks after ``rounds`` rounds, and each vector's code (the number of its entry per part, in hex) and squared error.

    Components become floor(scale * x). A part's entries begin as that part of the ``entries`` rows with the smallest id; equal ids
    stand by vector. Rounds assign every part to its nearest entry (the first of equals) and replace each entry by the floor of its
    points' mean; an entry without points stays. Only counts and sums per part and entry leave a task; the driver holds codebooks.

    Rows without a vector, or with a null or non-finite component, are dropped. Rows without an id are coded like others and
    are no first entries unless ids run out (nulls come last). Repeated rows and ids are rows of their own. With fewer rows than ``entries``
    there are as many entries as rows. Vectors of different lengths, and lengths that ``parts`` does not divide, are continued
    by zeros; components beyond ``LARGEST`` are set to it. ``keep`` maps new names to columns to carry along; other columns
    are ignored, whatever their names. An empty table gives no rows and empty codebooks.
    """
    keep = keep or {}
    number = F.col(vector_col).cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).alias("_id"), *[F.col(c).alias(f"_keep_{name}") for name, c in keep.items()], number.alias("_vector"))
    dims = -(-(kept.agg(F.max(F.size("_vector"))).first()[0] or 0) // parts) * parts
    first = kept.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(entries).select("_vector").collect()
    seeds = np.zeros((len(first), dims), np.int64)
    for row, (vector,) in zip(seeds, first):
        row[:len(vector)] = _whole(np.array(vector, np.float64), scale)
    codebooks = np.split(seeds, parts, axis=1)

    fields = [f for f in kept.schema.fields if f.name != "_vector"]
    carried = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    packed = ",".join(f.replace(" ", ":") for f in _TREE.split(", "))
    trees = stable(kept.mapInArrow(_grown(parts, dims, scale, chunk), f"rows array<struct<{carried}>>, trees array<struct<{packed}>>"), "trees")
    for _ in range(rounds):
        met = trees.select("trees").mapInArrow(_summed(codebooks), "part int, entry int, n bigint, total array<bigint>")
        found = met.select("part", "entry", "n", F.posexplode("total").alias("at", "sum")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
        # One row per component of a codebook: parts x entries x width, whatever the number of vectors.
        codebooks = [book.copy() for book in codebooks]
        for part, entry, at, n, total in found.collect():
            codebooks[part][entry, at] = total // n
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    rows = trees.mapInArrow(_coded(codebooks), f"{names}, code string, error bigint")
    renamed = rows.select(F.col("_id").alias(id_col), *[F.col(f"_keep_{name}").alias(name) for name in keep], "code", "error")
    return Compressed(renamed, codebooks)


def with_group_error(rows: DataFrame, group: str, out: str = "group_error") -> DataFrame:
    """Adds the sum of ``error`` over the rows of the same ``group``; nulls are one group. Give a written table.

    The sums are pre-aggregated and written, so that the join knows their size: a small table is broadcast, of a larger one
    skewed parts are split.
    """
    sums = stable(rows.groupBy(F.col(group).alias("_group")).agg(F.sum("error").alias(out)), "errors")
    return rows.join(sums, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
