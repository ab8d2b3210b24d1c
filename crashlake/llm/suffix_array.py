"""Suffix arrays of one shard by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their successor. The leftmost
S suffixes (LMS) are ordered by sorting the substrings between them, recursively on their
names while names repeat, and induce the order of all others: L suffixes from left to
right, S suffixes from right to left, in time linear in the shard.

A scan of the array visits bucket after bucket (suffixes with the same first symbol), and
a visited bucket only fills later ones and itself, there along runs of one symbol. So one
scan is one numpy step a bucket. Reduced strings have about as many symbols as places;
they are scanned place by place instead, on plain lists.
"""

from __future__ import annotations

import numpy as np

#: Buckets are scanned at once where they hold so many places on average.
BUCKET = 48


def _smaller(t: np.ndarray) -> np.ndarray:
    """Is the suffix S? Equal neighbours have the kind of the end of their run; the last symbol, the sentinel, is S."""
    n = len(t)
    out = np.ones(n, bool)
    if n > 1:
        differs = t[:-1] != t[1:]
        at = np.where(differs, np.arange(n - 1), n)
        ends = np.minimum.accumulate(at[::-1])[::-1]
        ends[ends == n] = n - 2
        out[:-1] = t[ends] < t[ends + 1]
    return out


def _runs(t: np.ndarray) -> np.ndarray:
    """How many equal symbols stand directly before each place."""
    n = len(t)
    at = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = t[1:] != t[:-1]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _chains(found: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The places themselves, then those one symbol before along their runs, then those two before, and so on."""
    more = runs[found]
    if not more.any():
        return found
    back = np.arange(int(more.sum()) + len(found)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
    return (np.repeat(found, more + 1) - back)[np.argsort(back, kind="stable")]


def _deal(places: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places grouped by symbol, in their order: symbols of the groups, sizes, rank inside a group, places."""
    order = np.argsort(symbols, kind="stable")
    symbols, places = symbols[order], places[order]
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    size = np.diff(np.append(first, len(symbols)))
    return symbols[first], size, np.arange(len(symbols)) - np.repeat(first, size), places


def _induce_buckets(t: np.ndarray, k: int, lms: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Suffix array induced from LMS places in order; a numpy step a bucket."""
    n = len(t)
    edge = np.zeros(k + 1, np.int64)
    np.cumsum(np.bincount(t, minlength=k), out=edge[1:])
    sa = np.empty(n, np.int64)
    symbols = t[lms]
    seeds = np.split(lms[np.argsort(symbols, kind="stable")], np.cumsum(np.bincount(symbols, minlength=k))[:-1])
    short = np.uint16 if k <= 1 << 16 else np.int64
    head = edge[:-1].copy()
    for c in range(k):
        large = sa[edge[c] : head[c]]
        if len(large):
            large = _chains(large, runs)
            head[c] = edge[c] + len(large)
            sa[edge[c] : head[c]] = large
        both = np.concatenate((large, seeds[c]))
        before = both[both > 0] - 1
        symbol = t[before]
        before, symbol = before[symbol > c], symbol[symbol > c].astype(short)
        if len(before):
            to, size, rank, before = _deal(before, symbol)
            sa[np.repeat(head[to], size) + rank] = before
            head[to] += size
    tail = edge[1:].copy()
    for c in range(k - 1, -1, -1):
        small = sa[tail[c] : edge[c + 1]][::-1]
        if c == 0:
            small = np.array([n - 1])
        if len(small):
            small = _chains(small, runs)
            tail[c] = edge[c + 1] - len(small)
            sa[tail[c] : edge[c + 1]] = small[::-1]
        both = np.concatenate((small, sa[edge[c] : head[c]][::-1]))
        before = both[both > 0] - 1
        symbol = t[before]
        before, symbol = before[symbol < c], symbol[symbol < c].astype(short)
        if len(before):
            to, size, rank, before = _deal(before, symbol)
            sa[np.repeat(tail[to], size) - 1 - rank] = before
            tail[to] -= size
    return sa


def _induce_places(t: np.ndarray, k: int, lms: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Suffix array induced from LMS places in order; place by place."""
    n = len(t)
    edge = np.zeros(k + 1, np.int64)
    np.cumsum(np.bincount(t, minlength=k), out=edge[1:])
    # the symbol before each place, if the suffix there is L (or S), else -1; place n stands for an empty slot
    large_before, small_before = (np.full(n + 1, -1, np.int64) for _ in range(2))
    large_before[1:n] = np.where(small[:-1], -1, t[:-1])
    small_before[1:n] = np.where(small[:-1], t[:-1], -1)
    start = np.full(n, n, np.int64)
    symbols = t[lms]
    order = np.argsort(symbols, kind="stable")
    many = np.bincount(symbols, minlength=k)
    rank = np.arange(len(lms)) - np.repeat(np.cumsum(many) - many, many)
    start[np.repeat(edge[1:] - many, many) + rank] = lms[order]
    sa = start.tolist()
    head, before = edge[:-1].tolist(), large_before.tolist()
    for j in sa:  # the scan meets what it has filled in on its way
        c = before[j]
        if c >= 0:
            sa[head[c]] = j - 1
            head[c] += 1
    tail, before = (edge[1:] - 1).tolist(), small_before.tolist()
    for j in reversed(sa):
        c = before[j]
        if c >= 0:
            sa[tail[c]] = j - 1
            tail[c] -= 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings, in text order: equal substrings share one, and names are in their order."""
    n, size = len(t), np.zeros(len(t), np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    a, b = ordered[:-1], ordered[1:]
    differs = size[a] != size[b]
    active = np.flatnonzero(~differs)
    at = 0
    while len(active):
        active = active[at < size[a[active]]]
        if not len(active):
            break
        unlike = t[a[active] + at] != t[b[active] + at]
        differs[active[unlike]] = True
        active = active[~unlike]
        at += 1
    name = np.empty(n, np.int64)
    name[ordered] = np.concatenate(([0], np.cumsum(differs)))
    return name[lms], int(differs.sum()) + 1


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of ``t``, symbols below ``k``, whose last one is 0 and stands nowhere else."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _smaller(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_bucket = n >= BUCKET * k
    runs = _runs(t) if by_bucket else None

    def induce(order: np.ndarray) -> np.ndarray:
        return _induce_buckets(t, k, order, runs) if by_bucket else _induce_places(t, k, order, small)

    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = induce(lms)
    ordered = sa[is_lms[sa]]
    names, different = _names(t, lms, ordered)
    if different < len(lms):
        ordered = lms[suffix_array(names, different)]
        sa = induce(ordered)
    elif not np.array_equal(ordered, lms):
        sa = induce(ordered)
    return sa


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``data`` (bytes) its predecessor in the array (-1: none) and the length of their common prefix.

    ``sa`` is that of the bytes followed by a sentinel. Where the bytes before a place and before its predecessor are
    equal, the prefix is one shorter than that of the place before; only the others are compared, eight bytes a step.
    """
    n = len(data)
    before = np.full(n + 1, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    before = before[:n]
    before[before == n] = -1  # the sentinel
    at = np.arange(n)
    shares = np.zeros(n, bool)
    inner = (at > 0) & (before > 0)
    i = at[inner]
    shares[inner] = data[i - 1] == data[before[inner] - 1]
    # the place before must have the byte before as its predecessor, which equal bytes bring about, as no suffix lies between
    alone = np.flatnonzero(~shares)
    words = np.ndarray((n + 1,), "<u8", np.concatenate((data, np.zeros(16, np.uint8))).tobytes(), strides=(1,))
    length = np.zeros(len(alone), np.int64)
    active = np.flatnonzero(before[alone] >= 0)
    while len(active):
        x, y = alone[active] + length[active], before[alone[active]] + length[active]
        inside = np.maximum(x, y) <= n
        active, x, y = active[inside], x[inside], y[inside]
        apart = words[x] ^ words[y]
        low = (apart & (~apart + np.uint64(1))).astype(np.float64)
        same = np.where(apart == 0, 8, np.log2(np.maximum(low, 1)).astype(np.int64) // 8)
        length[active] += same
        active = active[apart == 0]
    length = np.minimum(length, n - np.maximum(alone, before[alone]))  # not into the padding
    last = np.maximum.accumulate(np.where(shares, 0, at))
    full = np.zeros(n, np.int64)
    full[alone] = length
    return before, np.maximum(full[last] - (at - last), 0)
