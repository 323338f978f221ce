"""Byte-level BPE by dynamic programming over prefixes.

Each byte prefix of a piece has exactly one valid last token: the one whose pair
with the last token of what stands before it would be merged in no other way.
Going through the prefixes once gives them all; the encoding is read off from the
end.  Appending bytes only adds prefixes, and after an edit only the prefixes from
the edit on are computed again.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty

#: Units that a worker keeps in each of its two generations of encoded ones.
MEMORY = 500_000
_STOPS = ".,"
#: White space followed by a space and more white space, or by a space at the end:
#: the only places where cutting before every space would change the pieces.
_INNER_SPACE = re.compile(r"\s \s|\s \Z")
_CUT = re.compile(r"(?<=\S)(?= \S)")


class Vocabulary:
    """Ranks by bytes, and the pair that each token is merged from."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.bytes_of):
            token = self.bytes_of[rank]
            pair = (rank, rank)
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                if a < rank and b < rank and self._pair_stands(a, b):
                    pair = (a, b)
                    break
            self.halves[rank] = pair
            if pair[0] != rank:
                self.merged[pair] = rank

    def _pair_stands(self, left: int, right: int) -> bool:
        """Whether the two tokens, one after the other, are the encoding of their bytes.

        Undo merges in turn from the later one back, looking at each step for a merge
        across the border that would have come first.
        """
        before = 1 << 62
        while True:
            if self.merged.get((left, right), before) < before:
                return False
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left":
                    before, left = left, self.halves[left][1]
                    if left != before:
                        break
                else:
                    before, right = right + 1, self.halves[right][0]
                    if right + 1 != before:
                        break
            else:
                return True

    def stands(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= 4 * MEMORY:
                self.fits.clear()
            found = self.fits[key] = self._pair_stands(left, right)
        return found

    def extend(self, data: bytes, last: list[int]) -> None:
        """Complete ``last``, the last tokens of the prefixes, up to the whole of ``data``."""
        ranks, fits, longest = self.ranks, self.fits, self.longest
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = ranks.get(data[start:end])
                if token is not None:
                    if not start:
                        break
                    left = last[start - 1]
                    good = fits.get((left, token))
                    if good or good is None and self.stands(left, token):
                        break
            last.append(token)

    def read(self, data: bytes, last: list[int]) -> list[int]:
        """The tokens of the longest prefix in ``last``."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[last[end - 1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(piece, last)
        return self.read(piece, last)


class Prefixes:
    """One piece under change: exact appends, and edits that keep what stands before them."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Replace bytes [start, end); prefixes up to ``start`` stay."""
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start:]
        self.vocabulary.extend(self.data, self.last)

    def tokens(self) -> list[int]:
        return self.vocabulary.read(self.data, self.last)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """The ranks in the file; one vocabulary a worker."""
    with open(path, "rb") as file:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})


def units(text: str) -> list[str]:
    """Parts that hold whole pieces: a cut before every space, or where that is unsafe, only between others."""
    spaced = "  " in text or any(c + " " in text for c in "\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
    if (spaced or not text.isascii()) and _INNER_SPACE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class Encoder:
    """Whole texts to the bytes of their ids (little-endian, four a token), with a bounded memory of units."""

    def __init__(self, path: str, pattern: str) -> None:
        self.vocabulary, self.find = vocabulary(path), regex.compile(pattern).findall
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stops = {c: self._pieces(c) for c in _STOPS}

    def _pieces(self, unit: str) -> bytes:
        ids = [t for piece in self.find(unit) for t in self.vocabulary.encode_piece(piece.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _unit(self, unit: str) -> bytes:
        found = self.memory.get(unit)
        if found is not None:
            return found
        found = self.older.get(unit)
        if found is None:
            if len(unit) > 64:
                return self._pieces(unit)
            stop = self.stops.get(unit[-1:])
            if stop is not None and unit[-2:-1].isalpha():  # a stop after a letter is a piece of its own
                found = self._unit(unit[:-1]) + stop
            else:
                found = self._pieces(unit)
        if len(self.memory) >= MEMORY:
            self.memory, self.older = {}, self.memory
        self.memory[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        get, unit = self.memory.get, self._unit  # after a change of generation, ``get`` still finds what it did
        return b"".join([get(x) or unit(x) for x in units(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    Null texts are empty ones and have no tokens.
    """

    def of(batch: pa.RecordBatch) -> dict:
        tool = encoder(path, pattern)
        n, sha, back, ids = [], [], [], []
        for text in batch.column("text").to_pylist():
            code = tool.encode(text or "")
            n.append(len(code) // 4)
            sha.append(hashlib.sha256(code).hexdigest())
            back.append(hashlib.sha256(tool.decode(code)).hexdigest())
            if with_ids:
                ids.append(np.frombuffer(code, "<u4").astype(np.int32))
        out = {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": sha, "decoded_sha256": back}
        return out | ({"ids": ids} if with_ids else {})

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")), of, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` (doc_id, ids) as doc_id and text; bytes that are no UTF-8 become replacement marks."""

    def of(batch: pa.RecordBatch) -> dict:
        tool = encoder(path, pattern)
        ids = batch.column("ids").to_pylist()
        return {"doc_id": batch.column("doc_id"), "text": [tool.decode(np.array(x or [], "<u4").tobytes()).decode("utf-8", "replace") for x in ids]}

    return arrow_map(tokens.select("doc_id", "ids"), of, "doc_id bigint, text string")
