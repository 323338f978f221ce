"""Winnowing of long windows: content-chosen anchors that equal windows share.

A window of ``length`` units holds ``length - gram + 1`` grams; the one with the
smallest hash (leftmost among equals) is the window's anchor.  Equal windows have
equal anchors at equal offsets, so windows can be compared anchor by anchor.  A
run is a maximal series of consecutive windows of one document with the same
anchor occurrence; it covers ``windows + length - 1`` units.
"""

from __future__ import annotations

import numpy as np

_M = (1 << 64) - 1
#: Low bits that hold a gram's place; the same for texts of any length, so that equal windows break ties alike.
_PLACE = (1 << 31) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        _powers, _inverses = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, b)])) for b in (_BASE, _INVERSE))


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """``h`` with ``h[i]`` the polynomial hash of the first ``i`` codes, mod 2**64."""
    _grow(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _powers[: len(codes)], out=out[1:])
    return out


def slice_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the slices, equal for equal content wherever it stands."""
    return (h[end] - h[start]) * _inverses[start]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    have, m = 1, v
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    extra = width - have
    return np.minimum(m[: len(m) - extra], m[extra:]) if extra else m


def runs(codes: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of the documents laid end to end in ``codes``.

    ``bounds`` has the documents' starts and the end.  Returns, per run: the
    document's number, its first window's start (in ``codes``), the number of
    windows, the anchor's hash and place.
    """
    none = np.zeros(0, np.int64)
    n = len(codes)
    if n < length:
        return none, none, none, none.astype(np.uint64), none
    h = prefix_hash(codes)
    grams = (h[gram:] - h[:-gram]) * _inverses[: n - gram + 1]
    low = np.uint64(_PLACE)
    anchor = mix(grams)
    anchor &= ~low
    anchor |= np.arange(len(anchor), dtype=np.uint64)
    anchor = sliding_min(anchor, length - gram + 1) & low
    sizes = np.diff(bounds)
    valid = np.zeros(n + 1, np.int32)  # windows that lie in one document, as a difference array
    has = sizes >= length
    np.add.at(valid, bounds[:-1][has], 1)
    np.add.at(valid, bounds[1:][has] - length + 1, -1)
    valid = np.cumsum(valid[: len(anchor)]) > 0
    fresh = valid.copy()
    fresh[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= fresh[1:] | ~valid[1:]
    start, end = np.flatnonzero(fresh), np.flatnonzero(last)
    at = anchor[start].astype(np.int64)
    return np.searchsorted(bounds, start, "right") - 1, start, end - start + 1, grams[at], at


def words_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words (separated by ASCII white space) of the texts, laid end to end.

    Returns the words joined by single spaces, their starts and ends in it, and
    the documents' bounds as numbers of words.
    """
    split = [t.split() for t in texts]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(s) for s in split], out=bounds[1:])
    joined = b" ".join([b" ".join(s) for s in split if s])
    if not joined:
        return joined, np.zeros(0, np.int64), np.zeros(0, np.int64), bounds
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(joined)]]), bounds


def word_codes(joined: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word."""
    if not len(start):
        return np.zeros(0, np.uint64)
    h = prefix_hash(BYTE_CODES[np.frombuffer(joined, np.uint8)])
    return mix(slice_hash(h, start, end) + (end - start).astype(np.uint64))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs covered by the intervals ``[start, end)``; adjacent ones join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]


def chunks(sizes: list[int], most: int):
    """Slices of consecutive items of at most ``most`` in sum; a larger item stands alone."""
    begin = total = 0
    for i, s in enumerate(sizes):
        if i > begin and total + s > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += s
    if begin < len(sizes):
        yield slice(begin, len(sizes))
