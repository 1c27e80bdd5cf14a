"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as larger or smaller than their right neighbour, the
leftmost smaller ones are sorted, and all others are induced from them in one
pass up and one pass down the buckets of first characters. Each pass handles a
bucket, or a stretch of it, at once. The leftmost-smaller substrings are sorted
by the same two passes and named; if names repeat, the string of names is sorted
in turn, by pairs of names, pairs of pairs and so on, to the depth the caller
needs.
"""

from __future__ import annotations

import numpy as np


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; the last one is."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32)))
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    types = np.ones(n, dtype=bool)
    types[:-1] = step[np.minimum(following, n - 2)] > 0
    return types


def _ranks(chars: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by character, the place within each character, the counts."""
    order = np.argsort(chars, kind="stable")
    counts = np.bincount(chars, minlength=size)
    before = np.cumsum(counts) - counts
    return order, np.arange(len(chars)) - before[chars[order]], counts


def induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """The suffix array, given the leftmost-smaller suffixes in order. If these are
    in text order instead, their substrings come out sorted."""
    n = len(text)
    sizes = np.bincount(text, minlength=size)
    tails = np.cumsum(sizes)
    heads = tails - sizes
    array = np.full(n, -1, dtype=np.int32)
    order, place, counts = _ranks(text[leftmost], size)
    chosen = leftmost[order]
    seeds = tails - counts
    array[seeds[text[chosen]] + place] = chosen

    free = heads.copy()

    def push_larger(block: np.ndarray) -> None:
        at = block - 1
        at = at[at >= 0]
        at = at[~smaller[at]]
        if len(at):
            order, place, counts = _ranks(text[at], size)
            at = at[order]
            array[free[text[at]] + place] = at
            np.add(free, counts, out=free)

    for c in np.flatnonzero(sizes):
        low = heads[c]
        while low < free[c]:
            high = int(free[c])
            push_larger(array[low:high])
            low = high
        if seeds[c] < tails[c]:
            push_larger(array[seeds[c] : tails[c]])
    ends = free.copy()  # of the larger suffixes of each bucket
    free = tails.copy()

    def push_smaller(block: np.ndarray) -> None:
        at = block[::-1] - 1
        at = at[at >= 0]
        at = at[smaller[at]]
        if len(at):
            order, place, counts = _ranks(text[at], size)
            at = at[order]
            array[free[text[at]] - 1 - place] = at
            np.subtract(free, counts, out=free)

    for c in np.flatnonzero(sizes)[::-1]:
        high = tails[c]
        while free[c] < high:
            low = int(free[c])
            push_smaller(array[low:high])
            high = low
        push_smaller(array[heads[c] : ends[c]])
    array[0] = n - 1  # the end mark, smaller than all
    return array


def _order_names(names: np.ndarray, depth: int) -> np.ndarray:
    """The order of the suffixes of a string of names, by at least ``depth`` names."""
    ranks, step, n = names.astype(np.int64), 1, len(names)
    order = np.argsort(ranks, kind="stable")
    while True:
        ordered = ranks[order]
        if step >= depth or (ordered[1:] != ordered[:-1]).all():
            return order
        second = np.zeros(n, dtype=np.int64)
        second[:-step] = ranks[step:] + 1 if step < n else 0
        keys = ranks * (n + 1) + second
        # only names that still repeat have to be put in order again
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks = np.empty(n, dtype=np.int64)
        ranks[order] = fresh
        step *= 2


def suffix_array(text: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Suffixes of codes below ``size``, sorted by at least ``depth`` characters.
    The last code is 0 and occurs nowhere else."""
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    smaller = smaller_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    first = induce(text, smaller, leftmost, size)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    found = first[is_leftmost[first]]
    # name equal substrings, from one leftmost-smaller place to the next, alike
    index = np.zeros(n, dtype=np.int64)
    index[leftmost] = np.arange(len(leftmost))
    stops = np.append(leftmost[1:], n - 1)[index[found]]
    lengths = stops - found + 1
    same = _equal_ranges(text, found[:-1], found[1:], lengths[:-1], lengths[1:])
    names = np.concatenate([[0], np.cumsum(~same)])
    by_place = np.empty(len(leftmost), dtype=np.int64)
    by_place[index[found]] = names
    # a substring has two characters at least
    order = _order_names(by_place, depth // 2 + 2)
    return induce(text, smaller, leftmost[order], size)


def _equal_ranges(text, one, two, len_one, len_two) -> np.ndarray:
    equal = len_one == len_two
    open_pairs = np.flatnonzero(equal)
    k = 0
    while len(open_pairs):
        differ = text[one[open_pairs] + k] != text[two[open_pairs] + k]
        equal[open_pairs[differ]] = False
        open_pairs = open_pairs[~differ]
        k += 1
        open_pairs = open_pairs[len_one[open_pairs] > k]
    return equal


def common_prefixes(text: np.ndarray, array: np.ndarray, wanted: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes: for each place, how much its suffix shares with
    the one sorted before it, up to ``limit`` codes below 2^16; only where both
    places are wanted, 0 elsewhere. The text runs on for ``limit`` after those."""
    earlier = np.full(len(text), -1, dtype=np.int32)
    earlier[array[1:]] = array[:-1]
    found = np.zeros(len(text), dtype=np.int32)
    at = np.flatnonzero(wanted & (earlier >= 0))
    at = at[wanted[earlier[at]]]
    padded = np.concatenate([text.astype("<u2"), np.zeros(4, "<u2")])
    four = np.lib.stride_tricks.sliding_window_view(padded, 4)[: len(text)]
    lanes = np.ascontiguousarray(four).view("<u8").reshape(-1)
    k = 0
    while len(at) and k < limit:
        equal = lanes[at + k] == lanes[earlier[at] + k]
        rest = at[~equal]
        extra = np.zeros(len(rest), dtype=np.int64)
        alike = np.ones(len(rest), dtype=bool)
        for i in range(3):
            alike &= padded[rest + k + i] == padded[earlier[rest] + k + i]
            extra += alike
        found[rest] = k + extra
        at = at[equal]
        k += 4
    found[at] = k
    return np.minimum(found, limit)
