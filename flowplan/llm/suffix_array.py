"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S
suffix of each run is the anchor of a substring; those substrings are sorted by one round of
induction and named, the string of names is sorted in turn, and its order induces the order of all
suffixes. Induction takes one character bucket at a time and moves whole arrays.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last one is not."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    smaller = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    return np.repeat(smaller, np.diff(np.append(-1, ends)))


def _spread(items: np.ndarray, chars: np.ndarray, lists: list[list[np.ndarray]]) -> None:
    """Append ``items`` to the lists of their characters, in order."""
    order = np.argsort(chars, kind="stable")
    counts = np.bincount(chars)
    ends = np.cumsum(counts)
    items = items[order]
    for c in np.flatnonzero(counts).tolist():
        lists[c].append(items[ends[c] - counts[c] : ends[c]])


def _induce(text: np.ndarray, small: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the anchors in order. ``text`` has one byte per symbol."""
    n = len(text)
    empty = np.zeros(0, np.int32)
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    lower: list[list[np.ndarray]] = [[] for _ in range(256)]
    by_char: list[list[np.ndarray]] = [[] for _ in range(256)]
    _spread(anchors, text[anchors], by_char)
    large[int(text[-1])].append(np.asarray([n - 1], np.int32))
    left = [empty] * 256
    for c in range(256):
        done, wave = [], large[c]
        while wave:
            items = np.concatenate(wave) if len(wave) > 1 else wave[0]
            done.append(items)
            large[c] = []
            before = items[items > 0] - 1
            before = before[~small[before]]
            if len(before):
                _spread(before, text[before], large)
            wave = large[c]
        left[c] = np.concatenate(done) if done else empty
        if by_char[c]:
            before = np.concatenate(by_char[c])
            before = before[before > 0] - 1
            if len(before):
                _spread(before, text[before], large)
    right = [empty] * 256
    for c in range(255, -1, -1):
        done, wave = [], lower[c]
        while wave:
            items = np.concatenate(wave) if len(wave) > 1 else wave[0]
            done.append(items)
            lower[c] = []
            before = items[items > 0] - 1
            before = before[small[before]]
            if len(before):
                _spread(before, text[before], lower)
            wave = lower[c]
        right[c] = np.concatenate(done)[::-1] if done else empty
        before = left[c][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        if len(before):
            _spread(before, text[before], lower)
    return np.concatenate([x for pair in zip(left, right, strict=True) for x in pair])


def _names(text: np.ndarray, ordered: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """The rank of each anchor's substring, equal for equal substrings, in text order."""
    n, m = len(text), len(anchors)
    length = np.zeros(n, np.int32)
    length[anchors] = np.append(anchors[1:] + 1, n) - anchors
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    live, k = np.flatnonzero(same), 0
    while len(live):
        equal = text[a[live] + k] == text[b[live] + k]
        same[live[~equal]] = False
        k += 1
        live = live[equal]
        live = live[length[a[live]] > k]
    # The last substring runs to the end of the text, where nothing follows: it equals no other.
    last = anchors[-1]
    same[(a == last) | (b == last)] = False
    rank = np.zeros(n, np.int64)
    rank[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return rank[anchors] if m else rank[:0]


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Suffixes of the string of names in order, by doubling ranks of those not yet told apart.

    The alphabet of the names is about as large as their string, so buckets would not pay here.
    """
    m, span = len(names), 1
    order = np.argsort(names, kind="stable")
    key, slots = names[order], np.arange(m)
    rank = np.empty(m, np.int64)
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        alone = new & np.append(new[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return order
        items = order[slots]
        after = items + span
        second = np.where(after < m, rank[np.minimum(after, m - 1)] + 1, 0)
        key = rank[items] * (m + 1) + second
        turn = np.argsort(key, kind="stable")
        order[slots], key = items[turn], key[turn]
        span *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (uint8) in order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _types(text)
    anchors = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if not len(anchors):
        return _induce(text, small, anchors)
    is_anchor = np.zeros(n, bool)
    is_anchor[anchors] = True
    first = _induce(text, small, anchors)
    names = _names(text, first[is_anchor[first]], anchors)
    return _induce(text, small, anchors[_sorted_names(names)])


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the common prefix with the suffix before it in ``order``, and that suffix.

    Only positions whose left neighbour differs from that of the suffix before are compared; the
    prefix of any other is one shorter than that of the position to its left.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    first = (at == 0) | (before <= 0)
    rest = np.flatnonzero(~first)
    first[rest] = text[rest - 1] != text[before[rest] - 1]
    words = np.zeros(n + 16, np.uint64)
    padded = np.concatenate([text, np.zeros(24, np.uint8)])
    for k in range(8):
        words[:n] |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    heads = np.flatnonzero(first)
    common = np.zeros(n, np.int32)
    live = heads[before[heads] >= 0]
    a, b, k = live, before[live].astype(np.int64), np.zeros(len(live), np.int64)
    while len(live):
        equal = (words[a] == words[b]) & (np.maximum(a, b) + 8 <= n)
        if not equal.all():
            odd = ~equal
            x, y, z = a[odd], b[odd], k[odd]
            for step in range(8):  # up to eight symbols more
                more = (padded[x + step] == padded[y + step]) & (np.maximum(x, y) + step < n) & (z == k[odd] + step)
                z = z + more
            common[live[odd]] = z
            live, a, b, k = live[equal], a[equal], b[equal], k[equal]
        a, b, k = a + 8, b + 8, k + 8
    head = np.maximum.accumulate(np.where(first, at, 0))
    return np.maximum(common[head] - (at - head), 0), before


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each position also start at another position."""
    out = np.zeros(len(text), bool)
    if len(text) > length:
        common, before = permuted_prefixes(text, suffix_array(text))
        out = common >= length
        out[before[out]] = True
    return out
