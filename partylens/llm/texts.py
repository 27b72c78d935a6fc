"""Array kernels on the UTF-8 bytes of a column: words, spans and their hashes.

They run inside Arrow tasks on one bounded piece of a batch at a time. A hash is a
polynomial over the bytes modulo 2^64, taken from prefix sums, with a final mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 2 << 20  # bytes of text handled at once; a longer single text is one piece
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the len + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind, len(column) + 1, column.offset * width).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of at most ``limit`` bytes of text (or one row), with bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run without ``space`` bytes inside one text, and words per text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes from the prefix sums over all bytes."""
    _, down = _powers_to(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sorted_unique(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) pairs without repeats, by owner and then value."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], owner[first]


def blobs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary column: consecutive runs of ``values`` with the given lengths."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    if ends[-1] >= 2**31:
        raise ValueError("a piece of a batch is too large for one binary column")
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    )


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct runs of ``width`` words, A-Z lower-cased, by text and hash.

    A text of fewer words, but not none, has its whole sequence of words as its only run.
    """
    data = LOWER[data]
    starts, ends, per_text = words(data, offsets)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    word = span_hashes(prefix_sums(data), starts, ends)
    count = per_text[owner]
    place = np.arange(len(word)) - (np.cumsum(per_text) - per_text)[owner]
    size = np.minimum(width, count)
    first = place + size <= count
    at, run = np.flatnonzero(first), np.zeros(int(first.sum()), np.uint64)
    for k in range(width):
        inside = k < size[at]
        step = np.where(inside, word[np.minimum(at + k, len(word) - 1)], np.uint64(0)) if len(word) else np.zeros(0, np.uint64)
        run = mixed(run * np.uint64(0x9E3779B97F4A7C15) + step + inside.astype(np.uint64))
    value, owner = sorted_unique(run, owner[at])
    return owner, value
