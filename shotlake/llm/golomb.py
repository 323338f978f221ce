"""Golomb-Rice codes of sorted distinct integers, unary and binary parts apart."""

from __future__ import annotations

import numpy as np


def _bits(n: int, span: int) -> int:
    """The binary part's width that suits ``n`` values out of ``span``."""
    return max(0, (span // max(n, 1)).bit_length() - 1)


def encode(values: np.ndarray, low: int, span: int) -> bytes:
    """Code ``values`` (sorted, distinct, in [low, low + span))."""
    n, k = len(values), _bits(len(values), span)
    gaps = np.diff(values, prepend=low)
    high = gaps >> k
    unary = np.zeros(int(high.sum()) + n, np.uint8)
    unary[np.cumsum(high) + np.arange(n)] = 1
    rest = ((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8).ravel()
    return np.packbits(np.concatenate([unary, rest])).tobytes()


def decode(code: bytes, n: int, low: int, span: int) -> np.ndarray:
    k = _bits(n, span)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    ones = np.flatnonzero(bits)[:n]
    at = int(ones[-1]) + 1 if n else 0
    high = np.diff(ones, prepend=-1) - 1
    rest = bits[at : at + n * k].reshape(n, k).astype(np.int64) << np.arange(k) if k else np.zeros((n, 1), np.int64)
    return low + np.cumsum((high.astype(np.int64) << k) + rest.sum(axis=1))
