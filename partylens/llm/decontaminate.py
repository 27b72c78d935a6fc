"""Benchmark decontamination with suffix arrays over shards of the training texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.llm.suffixes import suffix_array
from partylens.llm.texts import pieces

WINDOW = 10
BLOCK = 32 << 20  # bytes of benchmark text that are sent to the tasks at once
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # on lower-cased bytes


@dataclass
class Tests:
    """The test side of one block: words as numbers, and each distinct window with the items that have it."""

    vocabulary: dict[bytes, int]
    window: np.ndarray  # distinct windows, padded with 0, as fixed-width bytes
    length: np.ndarray
    items: list[list[tuple[str, int]]]  # (item, first word) of each distinct window
    words: dict[str, list[int]]

    @staticmethod
    def of(rows: list[tuple[str, str]], window: int) -> Tests:
        vocabulary: dict[bytes, int] = {}
        words: dict[str, list[int]] = {}
        where: dict[tuple[int, ...], list[tuple[str, int]]] = {}
        for number, (item, text) in enumerate(rows):
            said = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in WORD.findall(text.encode().lower())]
            words[f"{number}:{item}"] = said
            for at in range(max(1, len(said) - window + 1)) if said else ():
                where.setdefault(tuple(said[at:at + window]), []).append((f"{number}:{item}", at))
        length = np.array([len(w) for w in where], np.int64)
        padded = np.zeros((len(where), window), ">u4")
        for i, w in enumerate(where):
            padded[i, :len(w)] = w
        return Tests(vocabulary, padded.view(f"S{4 * window}").ravel(), length, list(where.values()), words)


def _matches(tests: Tests, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(position in the shard, test window) of every occurrence, with ranks for longest matches.

    Only words of the tests can match, so the suffix array is built over the runs of such words that
    are long enough for the shortest window; ``kept`` maps its positions to the shard.
    """
    shortest = int(tests.length.min())
    known = ids > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    sizes = end - begin + 1  # each run with the unknown word after it
    kept = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    runs = np.append(ids, 0)[kept]
    order, levels = suffix_array(runs)
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), kept, levels
    padded = np.concatenate([runs, np.zeros(window, runs.dtype)])
    stop = np.flatnonzero(runs == 0)
    left = stop[np.searchsorted(stop, order)] - order  # words before the run ends
    columns = np.stack([np.where(k < left, padded[order + k], 0) for k in range(window)], axis=1).astype(">u4")
    keys = np.ascontiguousarray(columns).view(f"S{4 * window}").ravel()
    low = np.searchsorted(keys, tests.window, "left")  # binary search of every test suffix
    upper = np.frombuffer(tests.window.tobytes().ljust(4 * window * len(tests.window), b"\0"), np.uint8).reshape(-1, 4 * window).copy()
    upper[np.arange(4 * window) >= 4 * tests.length[:, None]] = 0xFF
    high = np.searchsorted(keys, upper.view(f"S{4 * window}").ravel(), "right")
    count = np.maximum(0, high - low)
    test = np.repeat(np.arange(len(count)), count)
    at = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
    return at, test, kept, levels


def _found(tests: Tests, window: int, id_name: str):
    schema = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string()), ("longest_item_at", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            raw, get = data.tobytes().lower(), tests.vocabulary.get
            said = [[get(w, 0) for w in WORD.findall(raw, a, b)] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            count = np.array([len(s) for s in said], np.int64)
            first = np.cumsum(count + 1) - (count + 1)  # a 0 after each text
            ids = np.zeros(int((count + 1).sum()), np.int64)
            for s, at in zip(said, first.tolist(), strict=True):
                ids[at:at + len(s)] = s
            spans, items, best = [[] for _ in said], [set() for _ in said], [(0, None, None, None) for _ in said]
            if len(tests.window) and ids.any():
                at, test, kept, _ = _matches(tests, ids, window)
                place = kept[at]
                text = np.searchsorted(first, place, "right") - 1
                order = np.lexsort((test, place))
                for p, t, x in zip(place[order].tolist(), test[order].tolist(), text[order].tolist(), strict=True):
                    spans[x] += [p - int(first[x]), p - int(first[x]) + int(tests.length[t])]
                    for item, q in tests.items[t]:
                        items[x].add(item.partition(":")[2])
                        words, n = tests.words[item], int(tests.length[t])
                        if n and q and p > first[x] and words[q - 1] == ids[p - 1]:
                            continue  # inside a match that began earlier
                        while q + n < len(words) and words[q + n] == ids[p + n]:
                            n += 1
                        if n > best[x][0]:
                            best[x] = (n, p - int(first[x]), item.partition(":")[2], q)
            arrays = [pa.array(count), pa.array(spans, schema.field(1).type), pa.array([sorted(i) for i in items], schema.field(2).type)]
            arrays += [pa.array([b[k] for b in best], schema.field(3 + k).type) for k in range(4)]
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(id_name)), *arrays], names=[id_name, *schema.names])

    return scan


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, longest, longest_at, longest_item, longest_item_at.

    ``spans`` of words that lie in an occurrence of a test window are hit; ``items`` are the ids (as text,
    sorted) of items with such a window, and the rest locates one longest verbatim match. Null and empty
    texts have no words; items without words match nothing; a null item id is the id "". Rows that repeat
    an id are looked at each. Other columns are not read.

    Each task cuts its rows into shards, builds the suffix array of a shard and looks every test suffix up
    in it by binary search; nothing is shuffled. The tests are sent in blocks of ``block`` bytes; more than
    one block means one pass over the texts for each, and the results of a text are brought together.
    """
    from partylens.session import stable

    tests = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block))
    id_type = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scans = []
    for number in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number) if blocks > 1 else tests
        held = Tests.of([tuple(r) for r in part.collect()], window)  # about ``block`` bytes
        source = texts.withColumn("mark", F.xxhash64("text")) if blocks > 1 else texts
        found = source.mapInArrow(
            _found(held, window, "doc_id"),
            f"doc_id {id_type}, n_words bigint, spans array<bigint>, items array<string>, longest bigint, longest_at bigint, longest_item string, longest_item_at bigint",
        ) if blocks == 1 else source.mapInArrow(
            _with_mark(_found(held, window, "doc_id")),
            f"doc_id {id_type}, n_words bigint, spans array<bigint>, items array<string>, longest bigint, longest_at bigint, longest_item string, longest_item_at bigint, mark bigint",
        )
        scans.append(stable(found, "matches") if blocks > 1 else found)
    every = scans[0]
    if blocks > 1:
        for more in scans[1:]:
            every = every.unionByName(more)
        best = F.max(F.struct("longest", "longest_at", "longest_item", "longest_item_at"))
        every = every.groupBy("doc_id", "mark").agg(
            F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            best.alias("best"), (F.count(F.lit(1)) / blocks).cast("int").alias("times"),
        ).withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).select("doc_id", "n_words", "spans", "items", "best.*")
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), (F.size("spans") / 2).cast("int") - 1), lambda i: F.struct(F.get("spans", 2 * i).alias("a"), F.get("spans", 2 * i + 1).alias("b"))))
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("hit"))
    union = F.aggregate(pairs, start, lambda s, p: F.struct(F.greatest(s["end"], p["b"]).alias("end"), (s["hit"] + F.greatest(F.lit(0), p["b"] - F.greatest(s["end"], p["a"]))).alias("hit")))
    return every.select(
        "doc_id", "n_words", F.when(F.size("spans") > 0, union["hit"]).otherwise(F.lit(0)).cast("bigint").alias("n_hit"),
        "items", "longest", "longest_at", "longest_item", "longest_item_at",
    )


def _with_mark(scan):
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.Table.from_batches(list(scan(iter([batch])))).combine_chunks().to_batches()
            for part in out:
                yield pa.RecordBatch.from_arrays([*part.columns, batch.column(batch.schema.get_field_index("mark"))], names=[*part.schema.names, "mark"])

    return marked
