"""Longest common prefixes of a text by breadth-first backward extension on its Burrows-Wheeler transform, up to a bound.

The suffix array is sorted to the bound by prefix doubling. Intervals of suffixes that start with a string w are extended
backwards, level by level: cw's interval ends where a common prefix of length |w| ends, so values appear in increasing order. What has no value
when |w| reaches the bound is at least the bound. Each boundary is set once, so the work follows the text, not its pairs.
"""

from __future__ import annotations

import numpy as np

#: Level at which extension starts: shorter prefixes are read off the sort keys.
SEED_LEVEL = 28
_PACKED = 7  # symbols of 9 bits in the first sort key


def suffix_order(symbols: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(sa, starts): suffixes sorted by their first `bound` symbols or more, and where sa changes within SEED_LEVEL symbols."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(_PACKED, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(_PACKED):
        key = (key << 9) | padded[k : n + k]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    del key, ordered, padded
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    depth, starts = _PACKED, None
    while depth < bound:
        if starts is None and depth >= SEED_LEVEL:
            starts = head.copy()
        alone = head & np.concatenate([head[1:], [True]])
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = sa[slots]
        pair = rank[at] * (n + 2) + rank[np.minimum(at + depth, n)] + 1
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
        sa[slots] = at
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        head[slots] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        depth *= 2
    return sa, head.copy() if starts is None else starts


def long_prefixes(symbols: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(sa, ends): ends[i] tells that suffixes sa[i - 1] and sa[i] share fewer than `bound` symbols. 0 is the separator, never extended by."""
    n = len(symbols)
    sa, starts = suffix_order(symbols, max(bound, SEED_LEVEL * 2))
    last = symbols[sa - 1].astype(np.uint16)  # sa == 0 takes the text's last symbol, a separator
    lf = np.empty(n, np.int64)
    lf[np.argsort(last, kind="stable")] = np.arange(n)
    first = np.zeros(n + 1, bool)  # where suffixes change their first symbol
    first[np.concatenate([[0], np.cumsum(np.bincount(last))])] = True
    ends = np.concatenate([starts, [True]])
    left = np.flatnonzero(starts)
    right = np.concatenate([left[1:], [n]])
    for _ in range(SEED_LEVEL, bound):
        if not len(left):
            break
        size = right - left
        one = size == 1
        a = left[one]
        a = lf[a[last[a] > 0]]
        many = ~one
        lo, hi = [a], [a + 1]
        if many.any():
            count = size[many]
            at = np.repeat(left[many] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            owner = np.repeat(np.arange(len(count)), count)
            solid = last[at] > 0
            to, owner = lf[at[solid]], owner[solid]
            order = np.argsort(to, kind="stable")
            to, owner = to[order], owner[order]
            if len(to):
                cut = np.flatnonzero((to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | first[to[1:]]) + 1
                lo.append(to[np.concatenate([[0], cut])])
                hi.append(to[np.concatenate([cut - 1, [len(to) - 1]])] + 1)
        lo, hi = np.concatenate(lo), np.concatenate(hi)
        new = ~ends[hi]
        left, right = lo[new], hi[new]
        ends[right] = True
    return sa, ends
