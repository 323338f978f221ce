"""Repeated substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Breadth-first backward extension: the intervals of all strings of one symbol give
those of two symbols, and so on.  The first string whose interval ends at a row
tells the common prefix of that row and the next; values come out in increasing
order, so the expansion stops at the minimum length, and the rows that no string
has ended by then share a prefix of at least that length.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (symbols 0 to 256) by their first ``depth`` symbols at least, by prefix doubling."""
    n, have = len(text), 7
    padded = np.concatenate([text.astype(np.int64), np.zeros(have, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(have):
        key = (key << 9) | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        if have >= depth or rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        if have < n:
            behind[:-have] = rank[have:] + 1
        key, have = rank * (n + 1) + behind, 2 * have


def repeated(strings: list[bytes], length: int) -> np.ndarray:
    """Flags, over the strings laid end to end, of the starts of ``length``-byte strings that stand twice or more.

    Substrings never cross from one string into the next.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1) - 1  # of the separators
    text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.uint16) + 1
    text[ends] = 0
    n = len(text)
    room = np.repeat(ends, sizes + 1) - np.arange(n)  # symbols before the next separator
    order = suffix_order(text, length)
    last = text[order - 1]  # the transform; of position 0 it is the final separator
    by_symbol = np.argsort(last, kind="stable")
    step = np.empty(n, np.int64)  # row of the suffix that is longer by one symbol
    step[by_symbol] = np.arange(n)
    ended = np.zeros(n + 1, bool)
    ended[0] = ended[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        size = high - low
        which = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        symbol = last[row]
        real = symbol > 0
        which, row, symbol = which[real], row[real], symbol[real]
        key = which * 257 + symbol
        if len(key) and np.any(key[1:] < key[:-1]):
            sort = np.argsort(key, kind="stable")
            key, row = key[sort], row[sort]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        new_low = step[row[first]]
        new_high = new_low + np.diff(np.append(first, len(key)))
        fresh = ~ended[new_high]
        low, high = new_low[fresh], new_high[fresh]
        ended[high] = True
        if not len(low):
            break
    fits = room[order] >= length
    same = ~ended[1:-1] & fits[1:] & fits[:-1]
    flags = np.zeros(n, bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    keep = np.ones(n, bool)
    keep[ends] = False
    return flags[keep]
