"""Suffix arrays by induced sorting, on whole numpy arrays.

Suffixes are classified as smaller or larger than their right neighbour, the
leftmost smaller ones are sorted by their substrings (induced, too) and, where
those repeat, by sorting the shorter string of their names, and all others are
induced from them bucket by bucket. The string of names is sorted by doubling,
not by classifying it again: its alphabet is too large for work by bucket.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one, the smallest, is."""
    n = len(text)
    smaller = np.zeros(n, np.bool_)
    smaller[-1] = True
    if n > 1:
        step = np.sign(np.diff(text.astype(np.int32)))
        # In a run of equal characters the step at its end decides.
        at = np.where(step != 0, np.arange(n - 1), n)
        following = np.minimum.accumulate(at[::-1])[::-1]
        known = following < n
        smaller[:-1][known] = step[following[known]] > 0
        smaller[:-1][~known] = False
    return smaller


def _append(sa: np.ndarray, heads: np.ndarray, kinds: np.ndarray, places: np.ndarray, step: int) -> None:
    """Write ``places`` to the buckets of ``kinds``, in order, from ``heads`` on."""
    order = np.argsort(kinds, kind="stable")
    sorted_kinds = kinds[order]
    counts = np.bincount(sorted_kinds, minlength=len(heads))
    first = np.cumsum(counts) - counts
    rank = np.arange(len(order)) - first[sorted_kinds]
    sa[heads[sorted_kinds] + step * rank] = places[order]
    heads += step * counts


def induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """The suffix array, given the leftmost smaller suffixes in order."""
    n = len(text)
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    larger_counts = np.bincount(text[~smaller], minlength=size)
    by_bucket = np.zeros(size + 1, np.int64)
    by_bucket[1:] = np.cumsum(np.bincount(text[leftmost], minlength=size))
    seeds = leftmost[np.argsort(text[leftmost], kind="stable")]
    sa = np.full(n, -1, np.int64)
    used = np.flatnonzero(counts)
    # Larger suffixes, from the front of the buckets.
    heads = starts.copy()
    for c in used:
        done = starts[c]
        while done < heads[c]:
            wave = sa[done : heads[c]]
            done = heads[c]
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _append(sa, heads, text[before], before, 1)
        wave = seeds[by_bucket[c] : by_bucket[c + 1]]
        before = wave[wave > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            _append(sa, heads, text[before], before, 1)
    # Smaller suffixes, from the back.
    tails = ends - 1
    for c in used[::-1]:
        done = ends[c] - 1
        while done > tails[c]:
            wave = sa[tails[c] + 1 : done + 1][::-1]
            done = tails[c]
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _append(sa, tails, text[before], before, -1)
        wave = sa[starts[c] : starts[c] + larger_counts[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[smaller[before]]
        if len(before):
            _append(sa, tails, text[before], before, -1)
        if c == text[-1] and sa[starts[c]] < 0:
            sa[starts[c]] = n - 1
    return sa


def order_of_names(names: np.ndarray) -> np.ndarray:
    """Suffixes of a string of numbers in order, by doubling the length compared."""
    n, rank, width = len(names), names.astype(np.int64), 1
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or width > n:
            return order
        width *= 2


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of ``text`` (characters below ``size``).

    Its last character must be its only 0.
    """
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    smaller = classify(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) > 1:
        sa = induce(text, smaller, leftmost, size)
        is_leftmost = np.zeros(n, np.bool_)
        is_leftmost[leftmost] = True
        ordered = sa[is_leftmost[sa]]
        # Equal substrings, up to the next leftmost smaller suffix, get one name.
        until = np.empty(n, np.int64)
        until[leftmost[:-1]] = leftmost[1:]
        until[leftmost[-1]] = n - 1
        length = until[ordered] - ordered + 1
        same = length[1:] == length[:-1]
        active = np.flatnonzero(same)
        a, b, k = ordered[active], ordered[active + 1], 0
        while len(active):
            equal = (text[a + k] == text[b + k]) & (smaller[a + k] == smaller[b + k])
            same[active[~equal]] = False
            k += 1
            go = equal & (length[active] > k)
            active, a, b = active[go], a[go], b[go]
        name_of = np.empty(n, np.int64)
        name_of[ordered] = np.concatenate(([0], np.cumsum(~same)))
        names = name_of[leftmost]
        if names.max() + 1 < len(names):
            leftmost = leftmost[order_of_names(names)]
        else:
            leftmost = ordered
    return induce(text, smaller, leftmost, size)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """At each position in ``order``, by position: the bytes, ``limit`` at most, that its
    suffix shares with the one before it in order, and with the one after it."""
    padded = np.concatenate((data.astype(np.uint8), np.zeros(limit + 16, np.uint8)))
    words = np.zeros(len(data) + limit + 8, np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    shared = np.zeros(max(0, len(order) - 1), np.int64)
    active = np.arange(len(shared))
    at = 0
    while len(active) and at < limit:
        odd = words[order[active] + at] ^ words[order[active + 1] + at]
        differs = odd != 0
        low = odd[differs] & (~odd[differs] + np.uint64(1))
        shared[active[differs]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        active = active[~differs]
        at += 8
    shared[active] = limit
    shared = np.minimum(shared, limit)
    before, after = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
    before[order[1:]] = shared
    after[order[:-1]] = shared
    return before, after
