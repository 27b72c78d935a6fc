"""Periodic runs of words, found by an online sparse dynamic programme over lags.

A lag is the distance of a word from an earlier occurrence of it. Reading from left to right, every earlier
occurrence makes the match length of its lag grow, a lag without a match ends, and a lag that ends with a sufficient
length is a run at once. The table is sparse in both directions: lags below 11 are followed at every third word, and
each doubling of the lag doubles the step, because a run of period q has q equal words in a row and so covers a
whole block of the step's length. What is matched at a step is the block that begins there, and only blocks that occur
twice in a text take part. So a text of n words costs about n log n, one word repeated n times included.
Blocks and ends are compared by hash; what is reported is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.llm.texts import mixed, pieces, prefix_sums, span_hashes, words

LEAST = 12  # words of a run, whatever its period
STEP = 3  # words between the steps of the smallest lags
PAIRS = 1 << 20  # (step, lag) matches held at once


def steps(longest: int, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """(step, smallest lag, largest lag) for texts of up to ``longest`` words.

    A lag d must match ``max(least - d, d)`` words in a row; that covers an aligned block when it is at least 2 * step - 1.
    """
    step, low = STEP if least >= 3 * STEP + 2 else 1, 1
    while 2 * low <= longest:
        yield step, low, 4 * step - 2
        step, low = 2 * step, 4 * step - 1


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number per different word, without collisions."""
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    letters = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class _Texts:
    """The words of several texts and what the passes over them share."""

    def __init__(self, word: np.ndarray, bounds: np.ndarray, least: int):
        self.word, self.least = word, least
        self.owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.begin, self.end = bounds[:-1], bounds[1:]
        self.sums = prefix_sums(mixed(word.astype(np.uint64)))

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        return span_hashes(self.sums, a, a + n) == span_hashes(self.sums, b, b + n)

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from (or, ``back``, before) the places a and b, up to ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(a - half, b - half, half) if back else self.equal(a, b, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def runs(self, lag: np.ndarray, first: np.ndarray, last: np.ndarray, step: int) -> list[tuple[int, int, int]]:
        """The ended lags as (start, length, period), where long enough."""
        at, to = first * step, (last + 1) * step
        owner = self.owner[at]
        left = self.reach(at, at - lag, np.minimum(step - 1, at - lag - self.begin[owner]), True)
        right = self.reach(to, to - lag, np.minimum(step - 1, self.end[owner] - to), False)
        at, to = at - left, to + right
        need = np.maximum(self.least - lag, lag)
        found = []
        for a, z, d, n in zip(*(x[to - at >= need].tolist() for x in (at, to, lag, need))):
            same = self.word[a:z] == self.word[a - d:z - d]
            if same.all():
                found.append((a - d, z - a + d, d))
                continue
            # Two different stretches had one hash: take the equal parts.
            cut = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
            found.extend((a + x - d, y - x + d, d) for x, y in zip(cut[::2].tolist(), cut[1::2].tolist()) if y - x >= n)
        return found


def find_runs(word: np.ndarray, bounds: np.ndarray, least: int = LEAST, pairs: int = PAIRS) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period; starts count over all texts.

    ``word`` holds the numbers of the words of all texts, ``bounds`` the place where each text begins, and the end.
    """
    texts = _Texts(word, bounds, least)
    known = np.zeros((0, 3), np.int64)
    alive = np.arange(len(word))
    size = np.int64(len(word) + 1)
    for step, low, high in steps(int(np.diff(bounds).max(initial=0)), least):
        alive = alive[alive + step <= texts.end[texts.owner[alive]]]
        block = mixed(span_hashes(texts.sums, alive, alive + step) + texts.owner[alive].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(block, kind="stable")
        block, place = block[order], alive[order]
        new = np.ones(len(block) + 1, bool)
        new[1:-1] = block[1:] != block[:-1]
        twice = ~(new[:-1] & new[1:])
        place, group = place[twice], np.cumsum(new[:-1])[twice]
        alive = np.sort(place)
        if not len(alive):
            break
        key = group * size + place
        steps_at = place % step == 0
        row, of = place[steps_at], group[steps_at]
        by_row = np.argsort(row)
        row, of = row[by_row], of[by_row]
        # Inside a known run of a period of at most half a step, the lags that stay inside are its multiples.
        upto = row - low
        tight = known[(known[:, 2] <= step // 2) & (known[:, 1] >= step)]
        if len(tight):
            tight = tight[np.argsort(tight[:, 0])]
            near = np.searchsorted(tight[:, 0], row, "right") - 1
            inside = (near >= 0) & (row + step <= tight[near, 0] + tight[near, 1])
            upto = np.where(inside, np.minimum(upto, tight[near, 0] - 1), upto)
        since = np.maximum(row - high, texts.begin[texts.owner[row]])
        a = np.searchsorted(key, of * size + since)
        z = np.maximum(np.searchsorted(key, of * size + upto, "right"), a)
        found = [(s, n, d) for part in _ended(row, place, a, z, step, texts, pairs) for s, n, d in texts.runs(*part, step)]
        known = _smallest(np.concatenate([known, np.array(found, np.int64).reshape(-1, 3)]))
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _ended(row: np.ndarray, place: np.ndarray, a: np.ndarray, z: np.ndarray, step: int, texts: _Texts, pairs: int):
    """Walks over the steps in order and yields (lag, first step, last step) of the lags that end."""
    total = np.cumsum(z - a)
    lag = first = last = np.zeros(0, np.int64)
    at = 0
    while at < len(row):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + pairs, "right")))
        n = z[at:to] - a[at:to]
        earlier = np.repeat(a[at:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        here = np.repeat(row[at:to], n)
        number = here // step
        lag, first, last = np.concatenate([lag, here - place[earlier]]), np.concatenate([first, number]), np.concatenate([last, number])
        order = np.lexsort((first, lag))
        lag, first, last = lag[order], first[order], last[order]
        if len(lag):
            owner = texts.owner[first * step]
            cut = np.ones(len(lag) + 1, bool)
            cut[1:-1] = (lag[1:] != lag[:-1]) | (first[1:] != last[:-1] + 1) | (owner[1:] != owner[:-1])
            begins, finishes = np.flatnonzero(cut[:-1]), np.flatnonzero(cut[1:])
            lag, first, last = lag[begins], first[begins], last[finishes]
            over = last < row[to - 1] // step
            yield lag[over], first[over], last[over]
            lag, first, last = lag[~over], first[~over], last[~over]
        at = to
    yield lag, first, last


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period; the others are its multiples."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _kept(runs: np.ndarray, n: int) -> np.ndarray:
    """False for the words that a run repeats."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The words of each text, joined by one space."""
    size = ends - starts + 1
    out = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(out[-1]) - np.repeat(out[:-1] - starts, size)
    letters = data[np.minimum(source, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    letters[out[1:] - 1] = 0x20
    # A text's last space is dropped.
    filled = np.diff(bounds) > 0
    keep = np.ones(len(letters), bool)
    keep[out[bounds[1:][filled]] - 1] = False
    offsets = out[bounds] - np.concatenate([[0], np.cumsum(filled)])
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(letters[keep].tobytes()))


def _scanned(least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "_text"):
            starts, ends, n = words(data, offsets)
            bounds = np.concatenate([[0], np.cumsum(n)])
            runs = find_runs(codes(data, starts, ends), bounds, least)
            kept = _kept(runs, len(starts))
            left = np.concatenate([[0], np.cumsum(kept)])[bounds]
            collapsed = _joined(data, starts[kept], ends[kept], left)
            owner = np.searchsorted(bounds, runs[:, 0], "right") - 1
            runs[:, 0] -= bounds[owner]
            listed = pa.StructArray.from_arrays([pa.array(runs[:, i].copy()) for i in range(3)], names=["start", "length", "period"])
            runs_of = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(n) + 1)).astype(np.int32)), listed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), runs_of, collapsed], names=["_id", "n_words", "runs", "collapsed"])

    return scan


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The runs of each text, and the text with every run cut to its first period: ``(id_col, n_words, runs, collapsed)``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch with smallest period q (words q apart are identical) of
    ``max(least, 2 * q)`` words or more that no neighbouring word extends; ``runs`` lists (start, length, period) by start
    and then period, words from 0. ``collapsed`` has the words outside of runs and each run's first q words, joined by
    one space. One task per slice of the table and no shuffle.

    A null text is empty: no words, no runs, an empty ``collapsed``. A null id stays null, and every row gives a row of
    its own, so repeated rows and ids give equal rows. Further columns are ignored, whatever their names. An empty table
    gives an empty one. A text is handled as a whole; it needs about 50 bytes of memory a byte.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = rows.mapInArrow(_scanned(least), f"_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return found.withColumnRenamed("_id", id_col)
