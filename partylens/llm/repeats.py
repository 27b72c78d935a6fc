"""Repeated byte strings across documents, by longest-previous-factor arrays over anchored shards.

Suffixes are brought together by content: of the ``GRAM``-byte substrings of each ``length``-byte string the
one with the least hash is its anchor, so equal strings have equal anchors wherever they stand. Neighbouring
strings with one anchor are a segment. Anchors that occur once in all texts fall away; the segments of the
others are dealt by anchor, equal segments are counted once, and a task builds the suffix array over the
segments of a shard. Previous and next smaller positions in suffix order give the longest earlier match of
every start; with the order reversed, the longest later match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.llm.jaccard import ENTRIES, FILTER, HALF, _dealt, _wanted_filter
from partylens.llm.suffixes import byte_common_prefix, byte_suffixes, previous_factors
from partylens.llm.texts import blobs, mixed, pieces, prefix_sums, span_hashes
from partylens.operators.ranking import ranked
from partylens.session import stable

LENGTH = 200
GRAM = 100
SHARD = 1 << 20  # bytes of segments in one suffix array, about; an anchor's segments stay together
PIECE = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a piece: text number, first start, number of starts and the anchor's hash.

    A start is a place where ``length`` bytes of the same text follow. Hashes are compared by their upper
    half, the leftmost of equal ones wins: both only depend on the bytes.
    """
    n, width = len(data), length - GRAM + 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ends = offsets[1:][text] if n else text
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    gram = span_hashes(sums, at, at + GRAM)
    key = (gram >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    blocks = -(-len(key) // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:len(key)] = key
    grid = grid.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n - length + 1)
    least = np.minimum(tail[start], head[start + width - 1])
    start = np.flatnonzero(start + length <= ends[start])  # windows of a valid start stay in its text
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(start):
        return none, none, none, np.zeros(0, np.uint64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(start) != 1) | (text[start[1:]] != text[start[:-1]])]))
    return text[start[new]], start[new], np.diff(np.append(new, len(start))), gram[anchor[new]]


def _described(length: int):
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text", PIECE):
            sums = prefix_sums(data)
            text, _, _, found = anchors(data, offsets, sums, length)
            raw = data.tobytes()
            sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("doc_id")), pa.array(np.diff(offsets)), pa.array(sha), blobs(found, np.bincount(text, minlength=rows.num_rows))],
                names=["doc_id", "n_bytes", "sha", "found"],
            )

    return described


def _again(table: pa.Table) -> pa.Table:
    """Hashes that occur more than once in all texts, by node."""
    value = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64)
    node = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
    order = np.lexsort((node, value))
    value, node = value[order], node[order]
    same = value[1:] == value[:-1]
    use = np.zeros(len(value), bool)
    use[1:] |= same
    use[:-1] |= same
    value, node = value[use], node[use]
    once = np.ones(len(value), bool)
    once[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
    value, node = value[once], node[once]
    order = np.argsort(node, kind="stable")
    value, node = value[order], node[order]
    names, sizes = np.unique(node, return_counts=True)
    return pa.table({"node": pa.array(names, pa.int64()), "hashes": blobs(value, sizes)})


def _let_through(shared):
    """Rows whose place the filter of wanted places has."""

    def let_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            place = batch.column(batch.schema.get_field_index("place")).to_numpy(zero_copy_only=False)
            at = (mixed(place.view(np.uint64)) & np.uint64(FILTER - 1)).astype(np.int64)
            yield batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))

    return let_through


def _segments(length: int):
    schema = pa.schema([("node", pa.int64()), ("start", pa.int64()), ("starts", pa.int64()), ("anchor", pa.int64()), ("sign", pa.int64()), ("sign2", pa.int64()), ("content", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text", PIECE):
            sums = prefix_sums(data)
            text, start, starts, found = anchors(data, offsets, sums, length)
            wanted = rows.column(rows.schema.get_field_index("hashes")).to_pylist()
            lists = [np.frombuffer(b"".join(w), np.uint64) for w in wanted]
            known = np.concatenate([mixed(x ^ np.uint64(i)) for i, x in enumerate(lists)])
            use = np.isin(mixed(found ^ text.astype(np.uint64)), known)
            text, start, starts, found = text[use], start[use], starts[use], found[use]
            end = start + starts + length - 1
            node = rows.column(rows.schema.get_field_index("node")).to_numpy(zero_copy_only=False)
            raw = data.tobytes()
            content = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            sign = span_hashes(sums, start, end)
            sign2 = np.array([int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little", signed=True) for c in content], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[text], pa.int64()), pa.array(start - offsets[text]), pa.array(starts), pa.array(found.view(np.int64)), pa.array(sign.view(np.int64)), pa.array(sign2), pa.array(content, pa.binary())],
                schema=schema,
            )

    return cut


def _factored(length: int, keep_first: bool):
    """Task over many anchors: for each distinct segment the runs of starts whose string occurs elsewhere."""

    def shard(content: list[bytes], starts: np.ndarray, node: np.ndarray, start: np.ndarray) -> list[bytes]:
        data = np.frombuffer(b"\0".join(content) + b"\0", np.uint8)
        sizes = np.array([len(c) + 1 for c in content])
        first = np.cumsum(sizes) - sizes
        order, levels = byte_suffixes(data, length)
        owner = np.repeat(np.arange(len(content)), sizes)
        inner = np.arange(len(data)) - first[owner]
        order = order[inner[order] < starts[owner[order]]]  # starts, not the bytes behind them
        lcp = np.zeros(len(order), np.int64)
        lcp[1:] = byte_common_prefix(data, levels, order[1:], order[:-1])
        lcp[lcp < length] = 0
        place = np.empty(len(order), np.int64)
        place[np.lexsort((start[owner[order]] + inner[order], node[owner[order]]))] = np.arange(len(order))
        match = previous_factors(order, lcp, place)
        if not keep_first:
            match = np.maximum(match, previous_factors(order, lcp, -place))
        hit = np.zeros(len(data) + 1, bool)
        hit[order[match >= length]] = True
        out = []
        for at, many in zip(first.tolist(), starts.tolist(), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], hit[at:at + many], [False]]).astype(np.int8)))
            out.append(edge.astype(np.int32).tobytes())
        return out

    def factored(table: pa.Table) -> pa.Table:
        anchor = table.column("anchor").to_numpy()
        order = np.argsort(anchor, kind="stable")
        col = {c: table.column(c).to_numpy()[order] for c in ("starts", "node", "start")}
        content = table.column("content").take(pa.array(order)).to_pylist()
        edges = np.append(np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0])), len(order)) if len(order) else np.zeros(1, np.int64)
        runs, at = [], 0
        while at < len(edges) - 1:
            to, size = at, 0
            while to < len(edges) - 1 and (size < SHARD or to == at):
                size += sum(map(len, content[edges[to]:edges[to + 1]]))
                to += 1
            a, b = int(edges[at]), int(edges[to])
            runs += shard(content[a:b], col["starts"][a:b], col["node"][a:b], col["start"][a:b])
            at = to
        return pa.table({"sign": table.column("sign").take(pa.array(order)), "sign2": table.column("sign2").take(pa.array(order)), "runs": pa.array(runs, pa.binary())})

    return factored


def _spans(length: int):
    """Occurrences with the runs of their segment to merged byte spans, as (node, from, to) lists."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            start, starts = (batch.column(at(c)).to_numpy(zero_copy_only=False) for c in ("start", "starts"))
            whole = batch.column(at("whole")).to_numpy(zero_copy_only=False)
            out = []
            for s, n, w, r in zip(start.tolist(), starts.tolist(), whole.tolist(), batch.column(at("runs")).to_pylist(), strict=True):
                pairs = np.array([[0, n]]) if w else np.frombuffer(r or b"", np.int32).reshape(-1, 2)
                out.append((pairs + [s, s + length - 1]).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(at("node")), pa.array(out, pa.binary())], names=["node", "spans"])

    return spans


def merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint, apart and sorted."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]], axis=1)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()), ("removed", pa.list_(pa.int64())), ("kept_sha256", pa.string())])
    for rows, data, offsets in pieces(batches, "text", PIECE):
        at = rows.schema.get_field_index
        out, shas = [], []
        raw = data.tobytes()
        for i, parts in enumerate(rows.column(at("spans")).to_pylist()):
            own = raw[offsets[i]:offsets[i + 1]]
            spans = merged(np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2))
            spans = spans[spans[:, 0] < len(own)]
            digest, before = hashlib.sha256(), 0
            for a, b in spans.tolist():
                digest.update(own[before:a])
                before = b
            digest.update(own[before:])
            out.append(spans.ravel())
            shas.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([rows.column(at("node")), rows.column(at("n_bytes")), rows.column(at("sha")), pa.array(out, schema.field(3).type), pa.array(shas)], schema=schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_first: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed, kept_sha256.

    ``removed`` lists the ends of the maximal byte runs (from, to, from, to, ...) covered by strings of
    ``length`` bytes that also start elsewhere; with ``keep_first`` only those that start earlier, in order of
    id and place, so the first copy stays; rows without id come last, and texts under one id stand by their SHA-256.
    Every row goes by its own text, whether ids repeat, are null or not: different texts are numbered, and rows with equal
    texts are copies of each other. Strings never cross texts; null texts are empty; an empty table gives an empty one.
    Other columns are not read. ``length`` must be more than ``GRAM``.
    """
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = stable(texts.mapInArrow(_described(length), "doc_id bigint, n_bytes bigint, sha string, found binary"), "described")
    classes = known.groupBy("sha", "n_bytes").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    # A node is a text: numbered in the order of ids, whatever the number of texts.
    by_id = [F.col("low").asc_nulls_last(), F.col("sha").asc(), F.col("n_bytes").asc()]
    classes = stable(ranked(classes, by_id, "node"), "classes")
    nodes = known.where(F.length("found") > 0).join(classes, ["sha", "n_bytes"]).where(F.col("doc_id").eqNullSafe(F.col("low"))).dropDuplicates(["node"])
    nodes = stable(nodes.select("node", "sha", "n_bytes", "low", "copies", "found"), "nodes")
    total, = nodes.agg(F.coalesce(F.sum(F.length("found") / 8), F.lit(0)).cast("bigint")).first()
    again = _dealt(nodes, "found", total, _again, "node bigint, hashes binary").groupBy("node").agg(F.collect_list("hashes").alias("hashes"))
    asked = stable(again, "again").join(nodes.select("node", "sha", "n_bytes", "low", "copies"), "node").withColumnRenamed("sha", "asked")
    # By id and text, so that of many copies only the rows of the lowest id meet; other texts mostly stay where they are.
    asked = asked.withColumn("key", F.xxhash64("low", "asked"))
    shared = docs.sparkSession.sparkContext.broadcast(_wanted_filter(asked.select(F.col("key").alias("node"))))  # FILTER bits, whatever the input
    signed = texts.withColumn("signed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)).withColumn("place", F.xxhash64("doc_id", "signed"))
    signed = signed.mapInArrow(_let_through(shared), signed.schema)
    carried = stable(
        signed.join(asked, (F.col("place") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("low")) & (F.col("signed") == F.col("asked")))
        .dropDuplicates(["node"]).select("node", "text", F.col("asked").alias("sha"), "n_bytes", "copies", "hashes"), "carried",
    )
    # Contents are cut a second time instead of written with every occurrence: only different ones are stored.
    cut = carried.select("node", "text", "hashes").mapInArrow(_segments(length), "node bigint, start bigint, starts bigint, anchor bigint, sign bigint, sign2 bigint, content binary")
    segments = stable(cut.drop("content"), "segments")
    distinct = cut.groupBy("anchor", "sign", "sign2").agg(
        F.count(F.lit(1)).alias("seen"), F.min(F.struct("node", "start")).alias("first"), F.first("starts").alias("starts"), F.first("content").alias("content")
    ).select("anchor", "sign", "sign2", "seen", "first.node", "first.start", "starts", "content")
    distinct = stable(distinct, "distinct")
    size, = distinct.agg(F.coalesce(F.sum(F.length("content")), F.lit(0))).first()
    lots = distinct.withColumn("lot", F.pmod(F.xxhash64("anchor"), F.lit(max(1, int(size) // (4 * SHARD)))))
    runs = lots.select("lot", "anchor", "sign", "sign2", "node", "start", "starts", "content").groupBy("lot").applyInArrow(_factored(length, keep_first), "sign bigint, sign2 bigint, runs binary")
    facts = runs.join(distinct.select("sign", "sign2", "seen", F.col("node").alias("first_node"), F.col("start").alias("first_start")), ["sign", "sign2"])
    facts = stable(facts.where((F.length("runs") > 0) | (F.col("seen") > 1)), "facts")
    later = (F.col("node") != F.col("first_node")) | (F.col("start") != F.col("first_start")) if keep_first else F.lit(True)
    hits = segments.select("node", "start", "starts", "sign", "sign2").join(facts, ["sign", "sign2"]).withColumn("whole", (F.col("seen") > 1) & later)
    spans = hits.select("node", "start", "starts", "whole", "runs").mapInArrow(_spans(length), "node bigint, spans binary").where(F.length("spans") > 0)
    found = carried.join(spans.groupBy("node").agg(F.collect_list("spans").alias("spans")), "node")
    removed = stable(found.select("node", "text", "n_bytes", "sha", "spans").mapInArrow(_removed, "node bigint, n_bytes bigint, sha string, removed array<bigint>, kept_sha256 string"), "removed")
    settled = classes.select("sha", "n_bytes", "node", "copies").join(removed.drop("node"), ["sha", "n_bytes"], "left")
    copy = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    if keep_first:
        first = F.row_number().over(_by_text())
        rows = known.select("doc_id", "sha", "n_bytes").withColumn("nth", first)
        copy = copy & (F.col("nth") > 1)
    else:
        rows = known.select("doc_id", "sha", "n_bytes")
    everything = F.array(F.lit(0).cast("bigint"), F.col("n_bytes"))
    return rows.join(settled, ["sha", "n_bytes"]).select(
        "doc_id", "n_bytes",
        F.when(copy, everything).otherwise(F.coalesce("removed", F.array().cast("array<bigint>"))).alias("removed"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def _by_text():
    from pyspark.sql import Window

    return Window.partitionBy("sha", "n_bytes").orderBy(F.col("doc_id").asc_nulls_last())
