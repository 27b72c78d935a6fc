"""Suffix arrays and what follows from them, in numpy, for one bounded shard in a task."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in suffix order, and the ranks of all positions at depth 1, 2, 4, ...

    Prefix doubling. With ``depth`` the order is only settled for that many symbols, equal beginnings
    going by position. A suffix that ends is smaller than its extensions.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64), []
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    levels, step = [rank.astype(np.int32)], 1
    order = np.argsort(rank, kind="stable")
    while step < (depth or n):
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        changed = np.ones(n, np.int64)
        changed[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        step *= 2
        levels.append(rank.astype(np.int32))
        if rank.max() == n:
            break
    return order, levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the suffixes at ``a`` and ``b``, up to 2^levels - 1 symbols."""
    n = len(levels[0]) if levels else 0
    a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in reversed(range(len(levels))):
        inside = (a < n) & (b < n)
        same = inside & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        same &= (a + (1 << level) <= n) & (b + (1 << level) <= n)
        length += same << level
        a, b = a + (same << level), b + (same << level)
    return length


def nearest_smaller(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry in suffix order the nearest earlier entry with a smaller place, and their common prefix.

    ``lcp[i]`` is the common prefix of entries i - 1 and i. Entries hop over those known to be larger,
    all at once, until nothing moves; -1 where there is none or the common prefix is gone.
    """
    to, common = np.arange(len(place)) - 1, lcp.copy()
    if len(place):
        common[0] = 0
    moving = np.flatnonzero((to >= 0) & (common > 0))
    while len(moving):
        moving = moving[(to[moving] >= 0) & (common[moving] > 0)]
        moving = moving[place[to[moving]] > place[moving]]
        over = to[moving]
        nxt, least = to[over], np.minimum(common[moving], common[over])
        to[moving], common[moving] = nxt, least
    gone = (to < 0) | (common <= 0)
    to[gone], common[gone] = -1, 0
    return to, common


def previous_factors(order: np.ndarray, lcp: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Longest previous factor of each entry in suffix order: its longest match with a smaller place.

    It lies at the nearest smaller place before or after in suffix order. With negated places this is the
    longest next factor.
    """
    before = nearest_smaller(place, lcp)[1]
    back = np.zeros(len(lcp), np.int64)
    if len(lcp):
        back[1:] = lcp[:0:-1]
    after = nearest_smaller(place[::-1], back)[1][::-1]
    return np.maximum(before, after)


def byte_suffixes(data: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Like ``suffix_array`` over bytes, settled for ``depth`` bytes, with ranks at depth 8, 16, 32, ...

    Eight bytes make the first key, so three rounds of doubling fall away. Equal beginnings stand in any order.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    step, levels = 8, []
    while n:
        order = np.argsort(key)
        changed = np.ones(n, np.int64)
        changed[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        levels.append(rank.astype(np.int32))
        if step >= depth or rank.max() == n:
            return order, levels
        key = rank * (n + 2)
        key[:n - step] += rank[step:]
        step *= 2
    return np.zeros(0, np.int64), levels


def byte_common_prefix(data: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the byte suffixes at ``a`` and ``b``, as far as the levels reach."""
    n = len(data)
    a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in reversed(range(len(levels))):
        reach = 8 << level
        same = (a + reach <= n) & (b + reach <= n)
        same &= levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)]
        length, a, b = length + same * reach, a + same * reach, b + same * reach
    going = np.ones(len(a), bool)
    for _ in range(8):
        going &= (a < n) & (b < n)
        going &= data[np.minimum(a, n - 1)] == data[np.minimum(b, n - 1)]
        length, a, b = length + going, a + going, b + going
    return length
