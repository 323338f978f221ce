"""Suffix-array dedup: bytes covered by a 400-byte string that stands anywhere else go.

Equal strings have equal anchors (see ``windows``), so the strings of one anchor
are a complete task of their own.  Runs whose whole bytes are equal (two
64-bit hashes, the anchor's and the run's) are one weighted string: if its weight
is two or more, every string in it is repeated.  All other runs of an anchor that
stands twice or more go, with one copy of each weighted string, into a
Burrows-Wheeler transform whose bounded interval expansion (``bwt``) finds the
strings that stand twice.  An anchor in very many different surroundings (the edge
of a passage that a large share of the documents has) is split first, into pieces
of few windows and then into the strings themselves, so that no task grows with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeated
from .common import arrow_map, lookup, materialize, shielded, utf8
from .removal import cleaned, features, fetch, remove, shared_runs
from .windows import chunks

LENGTH = 400
GRAM = 100
#: Different runs of one anchor above which it is split, and windows of a piece.
WIDE = 256
PIECE = 16
#: Bytes that one transform holds (the runs of one anchor stay together).
TRANSFORM = 1 << 20


def _marked(length: int):
    """Find the repeated strings among the runs of a partition, which is sorted by anchor."""

    def run(batches):
        def solve(g, text, rid, s, weight):
            cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            size = np.add.reduceat([len(t) for t in text], cuts) if len(g) else []
            edges = np.append(cuts, len(g))
            for piece in chunks(list(size), TRANSFORM):
                a, b = edges[piece.start], edges[piece.stop]
                some = text[a:b]
                flags = repeated(some, length)
                at = np.flatnonzero(flags)
                bounds = np.cumsum([0] + [len(t) for t in some])
                own = np.searchsorted(bounds, at, "right") - 1
                start = s[a:b][own] + at - bounds[own]
                mine = weight[a:b][own] == 1
                yield pa.RecordBatch.from_arrays([pa.array(rid[a:b][own][mine]), pa.array(start[mine].astype(np.int64))], ["rid", "s"])

        kept = None
        for batch in batches:
            now = [np.asarray(batch.column(k)) for k in ("g", "rid", "s", "weight")] + [batch.column("span").to_pylist()]
            if kept is not None:
                now = [np.concatenate([x, y]) for x, y in zip(kept[:4], now[:4])] + [kept[4] + now[4]]
            g, rid, s, weight, text = now
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield from solve(g[:cut], text[:cut], rid[:cut], s[:cut], weight[:cut])
            kept = [x[cut:] for x in now]
        if kept is not None:
            g, rid, s, weight, text = kept
            yield from solve(g, text, rid, s, weight)

    return run


def _spans(length: int):
    """Bytes of the runs asked for."""

    def of(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("g", "rid", "s", "m", "a", "weight", "wide", "span")}
        for text, rid, work in zip(utf8(batch), batch.column("rid").to_pylist(), batch.column("work").to_pylist()):
            for x in work:
                for k, v in (x | {"rid": rid, "span": text[x["s"] : x["s"] + x["m"] + length - 1]}).items():
                    out[k].append(v)
        return out

    return of


def _pieces(length: int):
    """A wide anchor's runs in pieces of ``PIECE`` windows, by their distance from the anchor.

    ``key`` is a hash of the bytes that all windows of a piece share, wherever the
    run begins and ends, and ``c`` of all bytes that this run has of it.
    """

    def of(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("key", "c", "rid", "s", "first", "m", "weight")}
        digest = xxhash.xxh3_64_intdigest
        for row in batch.to_pylist():
            span, a, m = memoryview(row["span"]), row["a"], row["m"]
            for q in range((a - m + 1) // PIECE, a // PIECE + 1):
                low, high = max(0, a - PIECE * q - PIECE + 1), min(m - 1, a - PIECE * q)
                common = span[max(0, a - PIECE * q) : a - PIECE * q - PIECE + 1 + length]
                key = digest(common, seed=q) - (1 << 63)
                c = digest(span[low : high + length]) - (1 << 63)
                for k, v in zip(out, (key, c, row["rid"], row["s"], low, high - low + 1, row["weight"])):
                    out[k].append(v)
        return out

    return of


def _strings(length: int):
    """A hash of each string of the pieces."""

    def of(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("w", "rid", "s", "weight")}
        for row in batch.to_pylist():
            span = memoryview(row["span"])
            for i in range(row["first"], row["first"] + row["m"]):
                for k, v in zip(out, (xxhash.xxh3_64_intdigest(span[i : i + length]) - (1 << 63), row["rid"], row["s"] + i, row["weight"])):
                    out[k].append(v)
        return out

    return of


def _wide(spans: DataFrame, length: int) -> DataFrame:
    """Ranges (rid, s, e) of repeated strings in the runs of wide anchors: piece by piece, then string by string."""
    span = spans.select("rid", "s", "m", "a", "weight", "span").dropDuplicates(["rid", "s"])
    pieces = arrow_map(span, _pieces(length), "key bigint, c bigint, rid bigint, s bigint, first int, m int, weight int")
    pieces = materialize(pieces, "byte-pieces")
    classes = pieces.groupBy("key", "c").agg(F.sum("weight").alias("all"), F.count("*").alias("n"))
    classes = materialize(classes, "byte-piece-classes")
    keys = classes.groupBy("key").agg(F.count("*").alias("k"), F.min("all").alias("least")).filter("k > 1 and least = 1")
    keys = materialize(keys.select("key", "k"), "byte-open-keys")
    same = lookup(pieces, classes.filter("all > 1").select("key", "c", "n"), ["key", "c"], "n").filter("weight = 1")
    same = same.select("rid", (F.col("s") + F.col("first")).alias("s"), (F.col("s") + F.col("first") + F.col("m") + (length - 1)).alias("e"))
    # pieces that stand once, and one of each that stands more often
    one = pieces.groupBy("key", "c").agg(*[F.first(k).alias(k) for k in ("rid", "s", "first", "m")], F.least(F.sum("weight"), F.lit(2)).cast("int").alias("weight"))
    todo = lookup(one, keys, ["key"], "k").select("rid", "s", "first", "m", "weight")
    strings = materialize(arrow_map(todo.join(span.select("rid", "s", "span"), ["rid", "s"]), _strings(length), "w bigint, rid bigint, s bigint, weight int"), "byte-strings")
    twice = strings.groupBy("w").agg(F.sum("weight").alias("all"), F.count("*").alias("n")).filter("all > 1")
    single = lookup(strings, materialize(twice.drop("all"), "byte-twice"), ["w"], "n").filter("weight = 1")
    return same.unionByName(single.select("rid", "s", (F.col("s") + length).alias("e")))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE) -> DataFrame:
    """One row per document: doc_id, xx, n (bytes), n_removed, spans (of bytes), kept_sha256.

    Null texts count as empty; equal rows are different documents, so that their
    strings stand twice.  An empty table gives an empty one; a text of any length is
    worked on whole.
    """
    found = features(docs, "byte", length, gram)
    runs = shared_runs(found)
    first = [F.first(k).alias(k) for k in ("rid", "s", "m", "a")]
    classes = materialize(runs.groupBy("g", "c").agg(F.sum("w").alias("n"), *first), "byte-classes")
    groups = classes.groupBy("g").agg(F.count("*").alias("k"), F.sum("n").alias("all"), F.min("n").alias("least")).filter("all > 1")
    groups = materialize(groups.drop("all"), "byte-groups")
    shared = materialize(lookup(classes, groups, ["g"], "k"), "byte-shared")
    copies = lookup(runs, shared.filter("n > 1").select("g", "c", "n"), ["g", "c"], "n")
    ranges = copies.select("rid", "s", (F.col("s") + F.col("m") + (length - 1)).alias("e"))

    # runs that stand once, beside one copy of each that stands more often
    todo = shared.filter("k > 1 and least = 1").select("rid", F.struct("g", "s", "m", "a", F.least("n", F.lit(2)).cast("int").alias("weight"), (F.col("k") > wide).alias("wide")).alias("w"))
    todo = todo.groupBy("rid").agg(F.collect_list("w").alias("work")).join(found.select("rid", "doc_id", "xx"), "rid")
    todo = materialize(todo, "byte-todo")
    spans = arrow_map(fetch(docs, todo).select("text", "rid", "work"), _spans(length), "g bigint, rid bigint, s bigint, m int, a int, weight int, wide boolean, span binary")
    spans = materialize(spans, "byte-spans")
    narrow = spans.filter("not wide").select("g", "rid", "s", "weight", "span").dropDuplicates(["rid", "s"])
    narrow = narrow.repartition("g").sortWithinPartitions("g", "rid", "s")
    marked = narrow.mapInArrow(_marked(length), "rid bigint, s bigint").select("rid", "s", (F.col("s") + length).alias("e"))
    ranges = ranges.unionByName(marked).unionByName(_wide(spans.filter("wide"), length))
    return remove(docs, found, ranges, "byte")


@shielded
def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated strings (a cut within a character leaves a replacement mark)."""
    return cleaned(docs, suffix_dedup(docs), "byte")
