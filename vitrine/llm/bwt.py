"""Common prefixes of bounded length from a Burrows-Wheeler transform.

Works on one bounded piece of text inside a task. Intervals of suffixes that
share a prefix are extended backwards by every symbol at once, breadth first:
after level l the boundaries between suffixes whose common prefix is shorter
than l are known, so prefix lengths come in increasing order, and the expansion
stops at the minimum length. What is still undivided then shares at least that
many symbols.
"""

from __future__ import annotations

import math

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Order of the rotations by their first ``depth`` symbols at least."""
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    width = min(63 // bits, depth)
    key = np.zeros(n, np.int64)
    ring = np.concatenate([symbols, np.resize(symbols, width)]).astype(np.int64)
    for j in range(width):
        key <<= bits
        key |= ring[j : j + n]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    slot = np.arange(n)
    first = np.maximum.accumulate(np.where(new, slot, 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    while width < depth:
        # Only groups that are still tied are sorted again, by what follows.
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        after = at + width
        after[after >= n] %= n
        key = (first[slots] << 32) | rank[after]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        split = np.ones(len(at), bool)
        np.not_equal(key[1:], key[:-1], out=split[1:])
        new[slots] = split
        first[slots] = np.maximum.accumulate(np.where(split, slots, 0))
        rank[at] = first[slots]
        width *= 2
    return order


def _extend(bound: np.ndarray, rows: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """One round: the intervals that ``bound`` divides are extended backwards to the
    rows that continue in them (row r in row follow[r]). Of the undivided ``rows``,
    those whose interval now differs from that of the row above get a boundary."""
    interval = np.cumsum(bound, dtype=np.int32)
    apart = interval[follow[rows]] != interval[follow[rows - 1]]
    bound[rows[apart]] = True
    return rows[~apart]


def common_prefix_classes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix positions in order, class of each): two suffixes are in one class
    when their first ``length`` symbols agree. ``symbols`` are dense, from 0.

    The first rounds extend by one symbol; once all strings of ``stride`` symbols
    have their intervals, rounds extend by such a string, and the last ones by
    single symbols again."""
    n = len(symbols)
    order = suffix_order(symbols, length)
    bwt = symbols[order - 1]
    # Row r of the sorted rotations continues in row psi[r], one symbol shorter:
    # the rows that the transform maps back to symbol c, in order, fill c's interval.
    psi = np.argsort(bwt, kind="stable").astype(np.int32)
    head = bwt[psi]
    bound = np.ones(n, bool)
    np.not_equal(head[1:], head[:-1], out=bound[1:])
    rows = np.flatnonzero(~bound).astype(np.int32)
    stride = math.isqrt(length)
    far, depth = psi, 1
    while depth < stride:
        rows = _extend(bound, rows, psi)
        far = psi[far]
        depth += 1
    while depth + stride <= length:
        rows = _extend(bound, rows, far)
        depth += stride
    while depth < length:
        rows = _extend(bound, rows, psi)
        depth += 1
    return order, np.cumsum(bound)
