"""Best-fit packing of documents into sequences by hierarchical residual packing.

Every partition fits its items best-fit (largest first) into bins; those that are
nearly full are final.  Groups of ``FAN`` partitions then treat the underfull bins
as items and fit them again, round after round, until one group is left.  Bins of
one size are alike, so a group gets only how many bins of each size its parts have
(``capacity`` numbers a part, whatever the table), and gives ranges: the bins of a
part and size with the numbers ``low`` to ``high`` go into new bins of one kind.
Members are joined with the places of their bins at the end.
"""

from __future__ import annotations

import array
import bisect
import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, release, small, text_or_empty

CAPACITY = 1024
END = 2
#: Bins with at most this much room are final at once.
NEARLY = 8
FAN = 16
#: Bins of one part and size are joined with their ranges in slices of so many numbers, so that no key is hot.
SLICE = 1 << 16
#: Pieces with their bins: a bin is the number ``place`` of its size in its part ``node``.
PIECE = "node bigint, size int, place bigint, final boolean, offset bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
RANGE = "node bigint, size int, slice bigint, low bigint, high bigint, shift bigint, times int, room bigint, parent bigint, new_size int, first bigint, final boolean"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items by number, in bins: largest first, each into the fullest bin that has room."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # sorted, the rooms for which there is a bin
    for i in order:
        at = bisect.bisect_left(rooms, sizes[i])
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= sizes[i]
        if room:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append(b)
    return bins


def _raw_bytes() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones for themselves, then from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def _tokenizer(path: str, pattern: str):
    """An encoder with the vocabulary of the file, which gives the same ids several times as fast.

    Only a byte-level BPE file without a normaliser is taken; its added tokens, which have to be plain ones that
    don't overlap, are found in texts before anything else.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    level = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or spec["model"]["type"] != "BPE" or level.get("type") != "ByteLevel" or level.get("add_prefix_space") or not level.get("use_regex", True):
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    odd = any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if odd or any(a != b and (a in b or any(a.endswith(b[:i]) for i in range(1, len(b)))) for a in added for b in added):
        raise ValueError(f"{path} has added tokens that are not plain")
    raw = _raw_bytes()
    ranks = {bytes(raw[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in added}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=added), tuple(added)


def token_bytes(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """Each text's ids, little-endian with four bytes a token."""
    tool, added = _tokenizer(path, pattern)
    out = []
    for t in texts:
        ids = tool.encode(t, allowed_special="all") if any(a in t for a in added) else tool.encode_ordinary(t)
        out.append(array.array("I", ids).tobytes())
    return out


def pieces(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(piece, start, length): the first piece is the shorter one."""
    n = len(ids) // 4
    first = n - (n - 1) // capacity * capacity
    return [(0, 0, first)] + [(i + 1, s, capacity) for i, s in enumerate(range(first, n, capacity))]


def fit_counts(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """``best_fit`` of so many items of each size: kinds of bins, as (size, times) of their items, with their numbers.

    Bins of one kind are filled alike, so the work grows with the sizes that occur, not with the items.
    """
    by_room: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, kind: list[tuple[int, int]], number: int) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((kind, number))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                kind, number = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                room, kind, number = capacity, [], left
            times = room // size  # the fullest bin with room stays that until it has none
            filled = min(number, left // times)
            if filled:
                put(room - times * size, [*kind, (size, times)], filled)
                left -= filled * times
            elif left:
                put(room - left * size, [*kind, (size, left)], 1)
                filled, left = 1, 0
            if number > filled and kind:
                put(room, kind, number - filled)
    return [x for kinds in by_room.values() for x in kinds]


def _merge(counts: list[tuple[int, int, int]], capacity: int, last: bool, slices: int) -> list[tuple]:
    """Ranges (as in RANGE, but for the parent) of the bins (node, size, number) of a group's parts."""
    total: dict[int, int] = {}
    begins: dict[int, list[tuple[int, int, int]]] = {}  # by size: where each part's bins begin in the group's
    for node, size, number in sorted(counts):
        begins.setdefault(size, []).append((total.get(size, 0), node, number))
        total[size] = total.get(size, 0) + number
    used = dict.fromkeys(total, 0)
    made: dict[tuple[int, bool], int] = {}  # bins so far of each new size
    out = []
    for kind, number in sorted(fit_counts(total, capacity)):
        new_size = sum(s * t for s, t in kind)
        final = last or new_size >= capacity - NEARLY
        first, room = made.get((new_size, final), 0), 0
        made[new_size, final] = first + number
        for size, times in kind:
            a, b = used[size], used[size] + number * times
            used[size] = b
            for begin, node, n in begins[size]:
                low, high = max(a, begin) - begin, min(b, begin + n) - begin
                while low < high:
                    to = min(high, (low // slices + 1) * slices)
                    out.append((node, size, low // slices, low, to, begin - a, times, room, new_size, first, final))
                    low = to
            room += size * times
    return out


def _emit(rows: list[tuple], schema: pa.Schema):
    for a in range(0, len(rows), 4096):
        columns = list(zip(*rows[a : a + 4096]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _sequence(level: int, node: Column, size: Column, place: Column) -> Column:
    """A sequence's number: its round, part and size, and its place among those; a part of round n has under 2**(20 + 4n) bins of a size."""
    bits = 20 + 4 * min(level, 5)
    return F.lit(level << 58) + F.shiftleft(node, bits + 11) + F.shiftleft(size.cast("bigint"), bits) + place


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True, fan: int = FAN, slices: int = SLICE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids
    (little-endian, four bytes a token).

    A null text is an empty one and has only the end token.  Repeated rows and rows
    without a doc_id are documents of their own; an empty table gives an empty one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if not 1 < capacity < 1 << 11:
        raise ValueError("a sequence holds 2 to 2047 tokens")
    spark = docs.sparkSession
    bounded_batches(spark)
    schema, range_schema = (to_arrow_schema(spark.createDataFrame([], x).schema) for x in (PIECE, RANGE))
    tail = np.array([end], "<u4").tobytes()

    def first_round(batches):
        node, full, items = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), token_bytes([t or "" for t in batch.column("text").to_pylist()], path, pattern)):
                ids += tail
                for piece, start, length in pieces(ids, capacity):
                    part = ids[4 * start : 4 * (start + length)]
                    member = (doc, piece, start, length, zlib.crc32(part), part if with_ids else None)
                    if length == capacity:
                        rows.append((node, capacity, full, True, 0, *member))
                        full += 1
                    else:
                        items.append(member)
            yield from _emit(rows, schema)
        rows, made = [], {capacity: full}
        for b in best_fit([m[3] for m in items], capacity):
            size, at = sum(items[i][3] for i in b), 0
            place = made[size] = made.get(size, 0) + 1
            for i in b:
                rows.append((node, size, place - 1, size >= capacity - NEARLY, at, *items[i]))
                at += items[i][3]
        yield from _emit(rows, schema)
        release()

    def merge(last: bool):
        def of(table: pa.Table) -> pa.Table:
            counts = list(zip(*[table.column(k).to_pylist() for k in ("node", "size", "n")]))
            parent = counts[0][0] // fan
            rows = [(*x[:8], parent, *x[8:]) for x in _merge(counts, capacity, last, slices)]
            return pa.Table.from_batches(list(_emit(rows, range_schema)), schema=range_schema)

        return of

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    now = materialize(texts.mapInArrow(first_round, PIECE), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    number = _sequence(0, F.col("node"), F.col("size"), F.col("place"))
    result = now.filter("final").select(*columns, number.alias("sequence_id"), "offset")

    under = now.filter("not final")
    bins = materialize(under.filter("offset = 0").select("node", "size", "place", F.struct("node", "size", "place").alias("of"), F.lit(0).cast("bigint").alias("at")), "bins")
    top = bins.agg(F.max("node")).first()[0]
    if top is None:
        return result
    places, level = None, 1
    while True:
        last = top < fan
        counts = bins.filter("at = 0").groupBy("node", "size").agg(F.count("*").alias("n"))
        ranges = materialize(counts.groupBy(F.expr(f"node div {fan}")).applyInArrow(merge(last), RANGE), f"ranges-{level}")
        held = bins.withColumn("slice", F.expr(f"place div {slices}")).join(small(ranges), ["node", "size", "slice"]).filter("place >= low and place < high")
        turn = F.col("place") + F.col("shift")
        at = F.col("at") + F.col("room") + F.pmod(turn, "times") * F.col("size")
        held = held.select("of", F.col("parent").alias("node"), F.col("new_size").alias("size"), (F.col("first") + F.expr("(place + shift) div times")).alias("place"), "final", at.alias("at"))
        held = materialize(held, f"bins-{level}")
        done = held.filter("final").select("of", _sequence(level, F.col("node"), F.col("size"), F.col("place")).alias("sequence_id"), "at")
        places = done if places is None else places.unionByName(done)
        if last:
            break
        bins, top, level = held.filter("not final").drop("final"), top // fan, level + 1
    places = materialize(places.select("of.*", "sequence_id", "at"), "places")
    placed = under.join(small(places), ["node", "size", "place"]).select(*columns, "sequence_id", (F.col("offset") + F.col("at")).alias("offset"))
    return result.unionByName(placed)
