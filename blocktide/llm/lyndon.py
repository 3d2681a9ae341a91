"""Lyndon arrays by Baier grouping, and the runs that their roots span.

The first phase of Baier's suffix sorter puts suffixes with the same longest
Lyndon prefix into one group. Groups are taken from the highest down; each
sends the suffixes in front of it, those that end where its members begin, to
higher groups of their own. When a group is taken its prefix is final, so the
Lyndon array comes out without sorting any suffix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def lyndon_array(text: Sequence[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each position.

    Any order of the symbols may be given, as numbers; for the reversed order
    give them negated.
    """
    n = len(text)
    if not n:
        return []
    symbols = sorted(set(text))
    counts = dict.fromkeys(symbols, 0)
    for symbol in text:
        counts[symbol] += 1
    # A group is named by the first of its places in the order; higher is later.
    start_of, at = {}, 0
    for symbol in symbols:
        start_of[symbol] = at
        at += counts[symbol]
    group = [start_of[symbol] for symbol in text]
    size, width = [0] * n, [0] * n  # members and length of the prefix, by group
    order, place = [0] * n, [0] * n
    for i, g in enumerate(group):
        place[i] = g + size[g]
        order[place[i]] = i
        size[g] += 1
        width[g] = 1
    lengths, before = [0] * n, [0] * n
    end = n
    while end:
        start = group[order[end - 1]]
        members = sorted(order[start:end])
        length = width[start]
        times: dict[int, int] = {}
        for i in members:
            lengths[i] = length
            # The nearest place to the left in a lower group; what is passed over is done.
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        end = start
        # Who is followed by more copies of the prefix is higher.
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            moved: dict[int, int] = {}
            some = by_times[k]
            for p in some:
                g = group[p]
                moved[g] = moved.get(g, 0) + 1
            filled = {}
            for p in some:
                g = group[p]
                # To the end of its group: change places with what stands there.
                filled[g] = done = filled.get(g, 0) + 1
                to, at = g + size[g] - done, place[p]
                other = order[to]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
            for g, m in moved.items():
                new = g + size[g] - m
                size[g] -= m
                size[new] = m
                width[new] = width[g] + k * length
                for q in order[new : new + m]:
                    group[q] = new
    return lengths


def _agree(text: np.ndarray, i: int, j: int, step: int) -> int:
    """How many symbols from ``i`` and ``j`` on agree, going by ``step`` (1 or -1)."""
    done, block = 0, 16
    most = len(text) - j if step > 0 else i + 1
    while done < most:
        width = min(block, most - done)
        if step > 0:
            a, b = text[i + done : i + done + width], text[j + done : j + done + width]
        else:
            a = text[i - done - width + 1 : i - done + 1][::-1]
            b = text[j - done - width + 1 : j - done + 1][::-1]
        odd = np.flatnonzero(a != b)
        if len(odd):
            return done + int(odd[0])
        done += width
        block *= 2
    return done


def runs(text: np.ndarray, copies: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``text``, by start, then period.

    ``period`` is the smallest one; a run has at least ``copies`` (3 or more)
    periods and ``shortest`` symbols. Any run with three periods holds, under one
    of the two orders, ``copies - 1`` Lyndon roots in a row, each the longest Lyndon word
    at its place. So chains of equal lengths are looked up and the first root of a
    chain is extended to both sides.
    """
    found = set()
    for sign in (1, -1):
        lengths = np.array(lyndon_array((text * sign).tolist()), np.int64)
        n = len(lengths)
        roots = np.arange(n)
        for k in range(1, copies - 1):
            following = roots + k * lengths[roots]
            roots = roots[following < n]
            following = following[following < n]
            roots = roots[lengths[following] == lengths[roots]]
        covered: dict[int, int] = {}  # where the last run of a period ends
        for i in roots.tolist():
            period = int(lengths[i])
            if i + period <= covered.get(period, 0):
                continue
            right = _agree(text, i, i + period, 1)
            left = _agree(text, i - 1, i + period - 1, -1)
            length = left + period + right
            covered[period] = i + period + right
            if length >= max(shortest, copies * period):
                found.add((i - left, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(codes: np.ndarray, owner: np.ndarray, copies: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that can lie in runs, and the number of the stretch that each lies in.

    ``owner`` numbers the texts that follow each other in ``codes``. A run with so
    many copies holds each of its words as often, so a word that occurs less often
    in its stretch ends it; this is repeated until no stretch changes. A run never
    crosses such a word, and lies in one stretch with all words that could extend it.
    """
    at = np.arange(len(codes))
    stretch = owner
    while len(at):
        _, inverse, counts = np.unique(
            stretch * np.int64(int(codes.max()) + 1) + codes[at], return_inverse=True, return_counts=True
        )
        stays = counts[inverse] >= copies
        gone = np.count_nonzero(~stays)
        at, parts = at[stays], stretch[stays]
        if not len(at):
            break
        cut = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(parts) != 0)))
        stretch = np.cumsum(cut) - 1
        sizes = np.bincount(stretch)
        long_enough = sizes[stretch] >= shortest
        if long_enough.all() and not gone:
            return at, stretch
        at = at[long_enough]
        stretch = stretch[long_enough]
    return at, np.zeros(0, np.int64)
