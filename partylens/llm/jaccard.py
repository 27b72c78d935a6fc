"""Exact similarity join on word shingles: rare-first candidates, size-banded tiles, bitmap bounds.

Two documents link when shared * 7 >= 3 * (size + size), that is at a Jaccard similarity of 0.75.

1. Equal sets are one node, named by a 64-bit hash of the set. A node's prefix, the first quarter of its
   shingles in hash order, must meet the first seventh of every smaller node that it links with. Prefix entries
   are dealt by hash. The nodes of one entry are cut by size: a node that has it in its first seventh and those up
   to a third larger form a group, overlapping ones together. Groups with the same smallest node are one tile, so
   the many shared entries of two near copies become one common tile.
2. Groups of more than ``CROWD`` nodes come from passages that many share. Their shingles are put last in
   the order, and nodes with such a shingle in their prefix are matched with each other once more by their
   new prefixes, for some rounds. A pair with one node outside has met in a smaller group already. What
   still is a crowd after the rounds becomes a tile as it is.
3. Inside a tile, nodes go by size; a pair is looked at while the sizes allow a link. Hashed bitmaps bound
   the overlap from above. Pairs that pass cut a tile into smaller ones, named by their smallest node: what
   only shares a passage leaves, and the many tiles of one family of near copies become one or few.
4. The shingles of what is left are taken from their texts again, found by a bit filter of bounded size that
   only ever lets too many through, and pairs that pass the bitmaps are intersected as sorted arrays. A
   pair that is connected already is skipped. Larger tiles are split, see ``_large``.

No step drops a candidate: the caps named here only choose between exact ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partylens.llm.components import components
from partylens.llm.texts import blobs, mixed, pieces, shingles
from partylens.session import stable

WIDTH = 5
CROWD = 1000  # nodes of a group in hash order
MAPS = 4000  # nodes of a tile that one task compares by bitmaps
TILE = 1000  # nodes of a tile that one task compares by shingles
LOT = 1 << 21  # shingles that a task of many tiles holds, about
PIVOTS = 8  # nodes of a split tile that all its parts see
ENTRIES = 1 << 21  # entries of a bucket, about
ROUNDS = 3
LAST = 1 << 20  # shingles that can be put last; beyond, crowds become tiles at once
FILTER = 1 << 26  # bits of the filter for wanted nodes
HALF = np.uint64(0xA24BAED4963EE407)
LABEL = np.uint64(16)  # low bits of a prefix entry that hold a label, the rest is of the shingle's hash
BANDS = 1024  # size bands while the size doubles
REACH = 426  # bands up to a third more, rounded up by one


def needed(a, b):
    """Shared shingles that sets of these sizes need."""
    return -(-3 * (a + b) // 7)


def prefix_length(n):
    """Of a set of n, so many first elements must meet those of any linked set, in any common order."""
    return n + (3 * n) // -4 + 1


def index_length(n):
    """So many first elements must meet the prefix of any linked set that is as large or larger."""
    return n + (6 * n) // -7 + 1


def entries(value: np.ndarray, n: int) -> np.ndarray:
    """The first shingles of a set of n, in the common order, with the set's size band and whether the place is beyond its index."""
    band = int(np.log2(n) * BANDS)
    label = (band << 1) + (np.arange(len(value)) >= index_length(n))
    return value >> LABEL << LABEL | label.astype(np.uint64)


def bitmap(value: np.ndarray) -> bytes:
    """One bit for the hash of each element, in the power of two of bits that leaves two to an element."""
    bits = np.zeros(max(64, 1 << int(2 * len(value) - 1).bit_length()), bool)
    bits[(mixed(value ^ HALF) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _signed(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles by text and hash, where each text's begin and end, and the name of each set."""
    owner, value = shingles(data, offsets, WIDTH)
    ends = np.searchsorted(owner, np.arange(rows.num_rows + 1))
    running = np.concatenate([[np.uint64(0)], np.cumsum(mixed(value * HALF + np.uint64(1)), dtype=np.uint64)])
    sign = mixed(running[ends[1:]] - running[ends[:-1]] + np.diff(ends).astype(np.uint64))
    return value, ends, sign.view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, name, bitmap and prefix of each text's set; the last two once in a task for equal sets."""
    seen: set[int] = set()
    for rows, data, offsets in pieces(batches, "text"):
        value, ends, sign = _signed(rows, data, offsets)
        spans = []
        for a, b, name in zip(ends[:-1].tolist(), ends[1:].tolist(), sign.tolist(), strict=True):
            spans.append((a, a if name in seen else b))
            seen.add(name)
        yield pa.RecordBatch.from_arrays(
            [rows.column(rows.schema.get_field_index("doc_id")), pa.array(np.diff(ends)), pa.array(sign),
             pa.array([bitmap(value[a:b]) if b > a else b"" for a, b in spans], pa.binary()),
             pa.array([entries(value[a:a + prefix_length(b - a)], b - a).tobytes() if b > a else b"" for a, b in spans], pa.binary())],
            names=["doc_id", "n", "node", "bitmap", "prefix"],
        )


def _later_prefixes(last: list[np.ndarray]):
    """New prefixes of the nodes that were in a crowd in every round so far; ``last`` has each round's shingles, without labels."""
    known = [np.sort(np.concatenate(last[:i])) for i in range(1, len(last) + 1)]

    def put_last(own: np.ndarray, listed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        name = own >> LABEL
        hit = listed[np.minimum(np.searchsorted(listed, name), len(listed) - 1)] == name
        free = own[~hit][:most]
        return np.concatenate([free, own[hit][:most - len(free)]]), hit

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for rows, data, offsets in pieces(batches, "text"):
            value, ends, sign = _signed(rows, data, offsets)
            nodes, found = [], []
            for a, b, name in zip(ends[:-1].tolist(), ends[1:].tolist(), sign.tolist(), strict=True):
                if name in seen or b == a:
                    continue
                seen.add(name)
                own, most = value[a:b], prefix_length(b - a)
                prefix, crowded = own[:most], True
                for listed, new in zip(known, last, strict=True):
                    crowded = crowded and bool(np.isin(prefix >> LABEL, new).any())
                    if not crowded:
                        break
                    prefix, _ = put_last(own, listed, most)
                if crowded:
                    nodes.append(name)
                    found.append(entries(prefix, b - a).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "prefix"])

    return prefixes


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The used chunks of a task's bit filter over its nodes."""
    bits = np.zeros(FILTER, bool)
    for batch in batches:
        bits[(mixed(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(FILTER - 1)).astype(np.int64)] = True
    chunks = np.packbits(bits).reshape(-1, 1 << 16)
    used = np.flatnonzero(chunks.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([chunks[i].tobytes() for i in used], pa.binary())], names=["chunk", "bits"])


def _either(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << 16, np.uint8)
    for more in table.column("bits").to_pylist():
        bits |= np.frombuffer(more, np.uint8)
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})


def _wanted_filter(nodes: DataFrame) -> np.ndarray:
    bits = np.zeros((FILTER >> 19, 1 << 16), np.uint8)
    for r in nodes.select("node").mapInArrow(_filter_bits, "chunk int, bits binary").groupBy("chunk").applyInArrow(_either, "chunk int, bits binary").collect():
        bits[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)  # FILTER / 8 bytes in all
    return bits.ravel()


def _contents(shared):
    """Shingles of the texts whose node the filter lets through, once in a task for equal sets."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for rows, data, offsets in pieces(batches, "text"):
            value, ends, sign = _signed(rows, data, offsets)
            at = (mixed(sign.view(np.uint64)) & np.uint64(FILTER - 1)).astype(np.int64)
            wanted = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            fresh = [i for i in wanted.tolist() if ends[i + 1] > ends[i] and not (int(sign[i]) in seen or seen.add(int(sign[i])))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sign[fresh], pa.int64()), pa.array([int(ends[i + 1] - ends[i]) for i in fresh], pa.int64()), pa.array([value[ends[i]:ends[i + 1]].tobytes() for i in fresh], pa.binary())],
                names=["node", "n", "content"],
            )

    return contents


def _entries(column: str, bits: int):
    """Rows (node, hashes) to rows (bucket, hashes, nodes), by the leading bits of a hash, without label, that is mixed anew.

    The hashes themselves would not do: a prefix has the smallest of its set, so its hashes lie in the first quarter of
    all, and a quarter of the buckets would get all entries.
    """

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            node = batch.column(at("node")).to_numpy(zero_copy_only=False)
            parts = [np.frombuffer(x, np.uint64) for x in batch.column(at(column)).to_pylist()]
            step = 0
            while step < len(parts):  # about ENTRIES at once
                to, size = step, 0
                while to < len(parts) and (size < ENTRIES or to == step):
                    size, to = size + len(parts[to]), to + 1
                value = np.concatenate(parts[step:to])
                owner = np.repeat(node[step:to], [len(p) for p in parts[step:to]])
                bucket = (mixed(value >> LABEL ^ HALF) >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                used, sizes = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), blobs(value[order], sizes), blobs(owner[order].astype(np.int64), sizes)], names=["bucket", "hashes", "nodes"])
                step = to

    return dealt


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a bucket by shingle, size and node without repeats, where each group begins, and its nodes.

    A group is what nodes with the shingle in their index reach: sizes up to a third more. Of equal bands the
    indexed nodes come first, so a linked pair is in one group whichever of the two is the larger.
    """
    value = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64)
    node = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
    order = np.lexsort((node, value))
    value, node = value[order], node[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
    value, node = value[new], node[new]
    name, label = value >> LABEL, (value & np.uint64((1 << int(LABEL)) - 1)).astype(np.int64)
    first = np.ones(len(value), bool)
    first[1:] = name[1:] != name[:-1]
    band = (np.cumsum(first) << int(LABEL)) + (label >> 1)  # no band of one shingle reaches those of the next
    reached = np.maximum.accumulate(np.where(label & 1, 0, band + REACH)) if len(value) else band
    first[1:] |= band[1:] > reached[:-1]
    begin = np.flatnonzero(first)
    return name, node, begin, np.diff(np.append(begin, len(value)))


def _tiled(crowd: int):
    """Task from the entries of a bucket to (tile, node) of all groups; those of crowds once for each shingle, with the shingle."""

    def tiled(table: pa.Table) -> pa.Table:
        name, node, begin, size = _gathered(table)
        leader, count = np.repeat(np.minimum.reduceat(node, begin) if len(node) else node, size), np.repeat(size, size)
        plain, many = (count > 1) & (count <= crowd), count > crowd
        pairs = np.unique(np.stack([leader[plain], node[plain]], axis=1), axis=0) if plain.any() else np.zeros((0, 2), np.int64)
        return pa.table({
            "tile": pa.array(np.concatenate([pairs[:, 0], leader[many]]), pa.int64()), "node": pa.array(np.concatenate([pairs[:, 1], node[many]]), pa.int64()),
            "shingle": pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(name[many].view(np.int64), pa.int64())]),
        })

    return tiled


def _dealt(rows: DataFrame, column: str, total: int, task, schema: str) -> DataFrame:
    bits = max(0, int(total // ENTRIES).bit_length())
    dealt = rows.select("node", column).mapInArrow(_entries(column, bits), "bucket int, hashes binary, nodes binary")
    return dealt.groupBy("bucket").applyInArrow(task, schema)


class _Tile:
    """Nodes of one tile by size, with bitmaps by width; answers which later nodes may link with one."""

    def __init__(self, n: np.ndarray, maps: list[bytes]):
        self.n = n
        self.words = np.array([len(m) // 8 for m in maps])
        self.rows: dict[int, np.ndarray] = {}
        for w in np.unique(self.words):
            self.rows[int(w)] = np.zeros((len(n), w), np.uint64)
        for i, m in enumerate(maps):
            bits = np.frombuffer(m, np.uint64)
            self.rows[len(bits)][i] = bits
            if len(bits) // 2 in self.rows:  # folded for the band below
                self.rows[len(bits) // 2][i] = bits[:len(bits) // 2] | bits[len(bits) // 2:]

    def partners(self, i: int, later: np.ndarray) -> np.ndarray:
        """Of the nodes ``later`` (by size), those whose sizes and bitmaps allow a link with i."""
        later = later[:np.searchsorted(self.n[later], self.n[i] * 4 // 3, "right")]
        found = []
        w = int(self.words[i])
        for width in (w, 2 * w):
            some = later[self.words[later] == width]
            if not len(some):
                continue
            rows = self.rows[w]
            mine, theirs = rows[i], rows[some]
            lost = np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64)
            lost2 = np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
            most = np.minimum(self.n[i] - lost, self.n[some] - lost2)
            found.append(some[most >= needed(self.n[i], self.n[some])])
        return np.concatenate(found) if found else later[:0]


def _joined(exact: bool):
    """Task over many tiles: links as a spanning forest, or the parts into which the bitmaps cut each tile.

    Columns: key (the tile), node, n, content, and ``role`` where a tile is split: 0 for plain members, 1 for
    nodes to be compared with all, 2 for members that are only compared with those. A part is named by its
    smallest node; nodes without a possible partner are in no part.
    """

    def joined(table: pa.Table) -> pa.Table:
        tile = table.column("key").to_numpy()
        n, node, role = table.column("n").to_numpy(), table.column("node").to_numpy(), table.column("role").to_numpy()
        order = np.lexsort((role, node, n, tile))
        content, starts = table.column("content"), np.flatnonzero(np.concatenate([[True], np.diff(tile[order]) != 0])) if len(order) else []
        left, right, parts = [], [], []
        for begin, end in zip(starts, [*starts[1:], len(order)], strict=True):
            own = order[begin:end]
            if len(own) < 2:
                continue
            raw = [content[int(i)].as_py() for i in own]
            arrays = [np.frombuffer(r, np.uint64) for r in raw] if exact else None
            band = _Tile(n[own], [bitmap(a) for a in arrays] if exact else raw)
            root = np.arange(len(own))
            for i in range(len(own)):
                later = np.arange(i + 1, len(own))
                if role[own[i]] == 2:
                    later = later[role[own[later]] == 1]
                found = band.partners(i, later[root[later] != root[i]])
                if not exact:
                    if len(found):
                        root[np.isin(root, root[found])] = root[i]
                    continue
                for j in found.tolist():
                    if root[i] == root[j]:
                        continue
                    shared = len(np.intersect1d(arrays[i], arrays[j], assume_unique=True))
                    if 7 * shared >= 3 * (len(arrays[i]) + len(arrays[j])):
                        left.append(node[own[i]])
                        right.append(node[own[j]])
                        root[root == root[j]] = root[i]
            if not exact:
                low = np.full(len(own), np.iinfo(np.int64).max)
                np.minimum.at(low, root, node[own])
                inside = np.bincount(root, minlength=len(own))[root] > 1
                parts.append((own[inside], low[root[inside]]))
        if not exact:
            rows = np.concatenate([x for x, _ in parts]) if parts else np.zeros(0, np.int64)
            names = np.concatenate([x for _, x in parts]) if parts else np.zeros(0, np.int64)
            return pa.table({"key": pa.array(tile[rows], pa.int64()), "part": pa.array(names, pa.int64()), "node": pa.array(node[rows], pa.int64()), "role": pa.array(role[rows], pa.int64())})
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return joined


def _compared(rows: DataFrame, group: list[str], shingles_held: int, exact: bool) -> DataFrame:
    """``_joined`` over rows dealt by tile, many tiles to a task."""
    held = rows if "role" in rows.columns else rows.withColumn("role", F.lit(0).cast("bigint"))
    lots = held.withColumn("key", F.xxhash64(*group)).withColumn("lot", F.pmod("key", F.lit(1 + shingles_held // LOT)))
    schema = "a bigint, b bigint" if exact else "key bigint, part bigint, node bigint, role bigint"
    return lots.select("lot", "key", "node", "n", "content", "role").groupBy("lot").applyInArrow(_joined(exact), schema)


def _weight(members: DataFrame, maps: DataFrame) -> int:
    """Shingles of all members together."""
    return members.join(maps.select("node", "n"), "node").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).first()[0]


def _linked(members: DataFrame, group: list[str], maps: DataFrame, contents: DataFrame) -> DataFrame:
    """Links inside groups: the bitmaps say which members a group needs, the shingles of those decide."""
    able = stable(_compared(members.join(maps, "node"), group, _weight(members, maps) // 8, False).select("key", "node", "role"), "able")
    return _compared(able.join(contents, "node"), ["key"], _weight(able, maps), True)


def _large(members: DataFrame, maps: DataFrame, contents: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links in tiles beyond ``TILE``: part by part with common pivots, then the rest against all.

    Every part is compared inside and with the tile's pivots, which connects a cluster of near copies
    across its parts with work in proportion to its size. Nodes that are not in the tile's largest
    component by then are compared with all nodes of the tile, in blocks: by bitmaps first, which move
    about a byte for two shingles, so that only possible partners bring their shingles. The work is in
    proportion to the tile's size times the number of such nodes.
    """
    parts = sizes.where(F.col("size") > TILE).withColumn("parts", F.ceil(F.col("size") / TILE))
    order = Window.partitionBy("tile").orderBy("hash", "node")
    big = stable(members.join(parts, "tile").withColumn("hash", F.xxhash64("node")).withColumn("part", F.pmod("hash", F.col("parts"))), "crowds")
    if not big.count():
        return members.sparkSession.createDataFrame([], "a bigint, b bigint")
    pivots = big.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PIVOTS).select("tile", "parts", "node")
    spread = pivots.select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node")
    first = big.select("tile", "part", "node").unionByName(spread).distinct()
    links = stable(_linked(first, ["tile", "part"], maps, contents), "links")
    placed = big.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    shares = placed.groupBy("tile", "component").count()
    main = shares.groupBy("tile").agg(F.max(F.struct("count", "component"))["component"].alias("main"))
    rest = stable(placed.join(main, "tile").where(F.col("component") != F.col("main")).select("tile", "parts", "node", "hash"), "rest")
    left = rest.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"))
    if not rest.count():
        return links
    against = big.join(left, "tile").select("tile", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node", F.lit(2).alias("role"))
    asked = rest.join(left, "tile").select("tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod("hash", F.col("blocks")).alias("block"), "node", F.lit(1).alias("role"))
    second = against.unionByName(asked).groupBy("tile", "part", "block", "node").agg(F.min("role").cast("bigint").alias("role"))
    return links.unionByName(_linked(second, ["tile", "part", "block"], maps, contents))


def _tiles(texts: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """(tile, node) such that every two nodes that link are together in a tile."""
    fields = "tile bigint, node bigint, shingle bigint"
    met = stable(_dealt(nodes, "prefix", total, _tiled(CROWD), fields), "met")
    tiles, last = met.where(F.col("shingle").isNull()), []
    for _ in range(ROUNDS):
        crowds = met.where(F.col("shingle").isNotNull()).select("shingle").distinct()
        listed = np.array([r[0] for r in crowds.limit(LAST + 1).collect()], np.int64).view(np.uint64)
        if not len(listed) or sum(map(len, last)) + len(listed) > LAST:
            break
        last.append(listed)
        prefixes = stable(texts.mapInArrow(_later_prefixes(last), "node bigint, prefix binary"), "prefixes")
        total, = prefixes.agg(F.coalesce(F.sum(F.length("prefix") / 8), F.lit(0)).cast("bigint")).first()
        met = stable(_dealt(prefixes, "prefix", total, _tiled(CROWD), fields), "met")
        tiles = tiles.unionByName(met.where(F.col("shingle").isNull()))
    return stable(tiles.unionByName(met.where(F.col("shingle").isNotNull())).select("tile", "node").distinct(), "tiles")


def _sizes(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("tile").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)


def _beside(held: DataFrame, tiles: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """``held`` (node, n, content) of the nodes in tiles, with a list of the node's tiles of up to ``most`` nodes.

    The list is joined where the rows of a node are brought together anyway, so contents need no second shuffle to meet it.
    """
    listed = tiles.join(sizes, "tile").groupBy("node").agg(F.collect_list(F.when(F.col("size") <= most, F.col("tile"))).alias("tiles"))
    return held.groupBy("node").agg(F.min("n").alias("n"), F.first("content").alias("content")).join(listed, "node")


def _within(held: DataFrame, unit: int, exact: bool) -> DataFrame:
    """``_compared`` over all tiles that ``held`` lists; ``unit`` shingles weigh as one."""
    weight, = held.agg(F.coalesce(F.sum(F.col("n") * F.size("tiles")), F.lit(0)).cast("bigint")).first()
    return _compared(held.select(F.explode("tiles").alias("tile"), "node", "n", "content"), ["tile"], weight // unit, exact)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id that links lead to. Ids are whole numbers; a row that repeats an id
    goes by its own text. A null id never names a component: such a row has the component of its equals and
    near copies with ids, else null. Null and empty texts and texts without words have 0 shingles and stand
    alone. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stable(texts.mapInArrow(_sets, "doc_id bigint, n bigint, node bigint, bitmap binary, prefix binary"), "sets")
    nodes = sets.where(F.length("prefix") > 0)
    total, = nodes.agg(F.coalesce(F.sum(F.length("prefix") / 8), F.lit(0)).cast("bigint")).first()
    tiles = _tiles(texts, nodes, total)
    sizes = stable(_sizes(tiles), "sizes")
    maps = stable(_beside(nodes.select("node", "n", F.col("bitmap").alias("content")), tiles, sizes, MAPS), "maps")
    large = tiles.join(sizes.where(F.col("size") > MAPS).select("tile"), "tile", "left_semi")
    groups = stable(_within(maps, 8, False).select(F.col("part").alias("tile"), "node").unionByName(large).distinct(), "groups")
    shared = docs.sparkSession.sparkContext.broadcast(_wanted_filter(groups.select("node").distinct()))  # FILTER bits, whatever the input
    found = texts.mapInArrow(_contents(shared), "node bigint, n bigint, content binary")
    sizes = stable(_sizes(groups), "sizes")
    contents = stable(_beside(found, groups, sizes, TILE), "contents")
    links = _within(contents, 1, True).unionByName(_large(groups, maps, contents, sizes))
    found = components(links)
    placed = sets.select("doc_id", "n", "node").join(found, "node", "left").withColumn("place", F.coalesce("component", "node"))
    lowest = placed.where(F.col("n") > 0).groupBy("place").agg(F.min("doc_id").alias("low"))
    return placed.join(lowest, "place", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))
