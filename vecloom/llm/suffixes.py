"""Suffix arrays over word codes, and binary search in them, vectorised over many queries."""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` codes that follow them (a full suffix array for depth >= len(codes)).

    Prefix doubling; each round only touches suffixes that still share their place with another one.
    """
    n = len(codes)
    order = np.argsort(codes)
    if not n:
        return order
    ordered = codes[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[n] = -1
    h = 1
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
    while h < depth and len(open_):
        suffix = order[open_]
        key = rank[suffix] * (n + 2) + rank[np.minimum(suffix + h, n)] + 1
        inside = np.argsort(key)
        key = key[inside]
        order[open_] = suffix[inside]
        new[open_[1:]] |= key[1:] != key[:-1]
        rank[order[open_]] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        last = np.append(new[1:], True)
        open_ = open_[~(new[open_] & last[open_])]
        h *= 2
    return order


def _bound(order: np.ndarray, padded: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray, upper: bool):
    """First index in [lo, hi) whose code ``depth`` words into the suffix is >= want (> want if upper)."""
    lo, hi = lo.copy(), hi.copy()
    last = len(padded) - 1
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) >> 1
        seen = padded[np.minimum(order[mid] + depth, last)]
        right = seen <= want[live] if upper else seen < want[live]
        lo[live[right]] = mid[right] + 1
        hi[live[~right]] = mid[~right]


def search(order: np.ndarray, codes: np.ndarray, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray, stop: np.ndarray):
    """Binary search of query[start : start + length] for every start.

    Returns the length of the longest prefix found, the suffix range of that prefix, and the suffix range of the first
    ``stop`` words, which is empty where fewer were found.
    """
    n, m = len(order), len(starts)
    padded = np.append(codes, np.uint64(0))
    best = np.zeros(m, np.int64)
    lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
    at_stop = np.zeros((2, m), np.int64)
    live = np.arange(m)
    depth = 0
    while True:
        live = live[lengths[live] > depth]
        if not len(live):
            return best, lo, hi, at_stop
        want = query[starts[live] + depth]
        a = _bound(order, padded, lo[live], hi[live], depth, want, False)
        b = _bound(order, padded, a, hi[live], depth, want, True)
        found = b > a
        live, a, b = live[found], a[found], b[found]
        depth += 1
        lo[live], hi[live], best[live] = a, b, depth
        reached = stop[live] == depth
        at_stop[0, live[reached]], at_stop[1, live[reached]] = a[reached], b[reached]
