"""What window dedup operators share: anchor runs of all texts, and cutting spans out of texts.

Documents are addressed by ``rid``, given once when the features are written;
texts are found again by ``(doc_id, xxhash64(text))``, so null or repeated ids are no
problem.  Rows that repeat both are one document of weight ``w`` until the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, lookup, materialize, small, text_or_empty, utf8
from .windows import BYTE_CODES, chunks, merged, runs, word_codes, words_of

#: Bytes of text that are worked on at once (a longer text stands alone).
CHUNK = 1 << 18
#: Of each run: the anchor's and the run's hash, first window, windows, and the anchor's distance from the first window.
RUNS = "array<struct<g:bigint,c:bigint,s:int,m:int,a:int>>"
_NOTHING = hashlib.sha256(b"").hexdigest()


def texts(docs: DataFrame) -> DataFrame:
    """The columns that matter here; others, whatever their names, are left out."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("xx"))


def _units(data: list[bytes], unit: str):
    """Bounds, codes and a function giving the bytes of units [a, b) of the texts laid end to end."""
    if unit == "byte":
        joined = b"".join(data)
        bounds = np.zeros(len(data) + 1, np.int64)
        np.cumsum([len(x) for x in data], out=bounds[1:])
        return joined, bounds, BYTE_CODES[np.frombuffer(joined, np.uint8)], None, None
    joined, start, end, bounds = words_of(data)
    return joined, bounds, word_codes(joined, start, end), start, end


def features(docs: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """One row per different document: rid, doc_id, xx, w (rows), n (units), sha (of the whole text), runs."""

    def of(batch: pa.RecordBatch) -> dict:
        data = utf8(batch)
        n, sha, parts, sizes = [], [], [], []
        for piece in chunks([len(x) for x in data], CHUNK):
            some = data[piece]
            joined, bounds, codes, ws, we = _units(some, unit)
            doc, start, m, g, at = runs(codes, bounds, length, gram)
            first, last = start, start + m + length - 1
            if unit == "word" and len(start):
                first, last = ws[start], we[last - 1]
            view = memoryview(joined)
            c = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(start))
            parts.append((g.view(np.int64), c.view(np.int64), (start - bounds[doc]).astype(np.int32), m.astype(np.int32), (at - start).astype(np.int32)))
            sizes.append(np.bincount(doc, minlength=len(some)))
            n.append(np.diff(bounds))
            sha += [hashlib.sha256(x if unit == "byte" else b" ".join(x.split())).hexdigest() for x in some]
        offsets = np.zeros(len(data) + 1, np.int32)
        np.cumsum(np.concatenate(sizes), out=offsets[1:])
        columns = [pa.array(np.concatenate(x)) for x in zip(*parts)]
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["g", "c", "s", "m", "a"]))
        return {"doc_id": batch.column("doc_id"), "xx": batch.column("xx"), "n": np.concatenate(n), "sha": sha, "runs": listed}

    found = arrow_map(texts(docs), of, f"doc_id bigint, xx bigint, n bigint, sha string, runs {RUNS}")
    return _once(materialize(found.withColumn("rid", F.monotonically_increasing_id()), f"{unit}-runs"))


def _once(found: DataFrame) -> DataFrame:
    """The first of the rows that repeat doc_id and text, with their number ``w``."""
    key = ["id", "none", "xx"]
    keyed = found.select("rid", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "xx")
    again = materialize(keyed.groupBy(*key).agg(F.min("rid").alias("first"), F.count("*").alias("n")).filter("n > 1"), "repeated-rows")
    if again.isEmpty():
        return found.withColumn("w", F.lit(1).cast("bigint"))
    others = materialize(lookup(keyed, again, key, "n").filter("rid <> first").select("rid"), "repeated-rids")
    weights = again.select(F.col("first").alias("rid"), F.col("n").alias("w"))
    once = found.join(small(others), "rid", "left_anti").join(small(weights), "rid", "left")
    return materialize(once.withColumn("w", F.coalesce("w", F.lit(1).cast("bigint"))), "different-runs")


def fetch(docs: DataFrame, want: DataFrame) -> DataFrame:
    """``want`` (with doc_id and xx, materialised) with the texts; its bytes decide on a broadcast.

    Repeated rows of ``docs`` give the text as often, so ``want`` should have a (doc_id, xx) once.
    """
    want = small(want.withColumnsRenamed({"doc_id": "_id", "xx": "_xx"}))
    found = texts(docs)
    return found.join(want, found.doc_id.eqNullSafe(F.col("_id")) & (found.xx == F.col("_xx"))).drop("_id", "_xx")


def cut(data: bytes, unit: str, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """``data`` without the units in the intervals (in order, apart from each other)."""
    whole = data if unit == "byte" else data.split()
    edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(whole)]
    kept = [whole[a:b] for a, b in zip(edges[::2], edges[1::2])]
    return b"".join(kept) if unit == "byte" else b" ".join([w for part in kept for w in part])


def _cover(batch: pa.RecordBatch) -> dict:
    """Merge each document's ranges."""
    lists = batch.column("ranges")
    at, flat = lists.offsets.to_numpy(), lists.flatten()
    s, e = (np.asarray(flat.field(k)).astype(np.int64) for k in ("s", "e"))
    at = at - at[0]
    spans, removed = [], []
    for a, b in zip(at[:-1], at[1:]):
        x, y = merged(s[a:b], e[a:b])
        spans.append([{"start": int(i), "end": int(j)} for i, j in zip(x, y)])
        removed.append(int((y - x).sum()))
    return {"rid": batch.column("rid"), "spans": spans, "n_removed": removed}


SPANS = "array<struct<start:bigint,end:bigint>>"


def remove(docs: DataFrame, found: DataFrame, ranges: DataFrame, unit: str) -> DataFrame:
    """One row per document: doc_id, xx, n, n_removed, spans, kept_sha256.

    ``found`` comes from ``features``; ``ranges`` has rid, s, e in units.  Only texts
    that lose a part are read again: the digest of an untouched one is known, and of
    one that loses everything nothing is left.
    """
    gathered = ranges.groupBy("rid").agg(F.collect_list(F.struct(F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))).alias("ranges"))
    spans = arrow_map(gathered, _cover, f"rid bigint, spans {SPANS}, n_removed bigint")
    state = found.select("rid", "doc_id", "xx", "w", "n", "sha").join(spans, "rid", "left")
    state = materialize(state.withColumn("n_removed", F.coalesce("n_removed", F.lit(0))), f"{unit}-state")
    part = (F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n"))
    of_rest = F.when(F.col("n_removed") == 0, F.col("sha")).otherwise(F.lit(_NOTHING))
    rest = state.filter(~part).withColumn("kept_sha256", of_rest)
    torn = state.filter(part)
    columns = ["rid", "doc_id", "xx", "w", "n", "n_removed", "spans"]
    text = fetch(docs, torn.select(*columns))

    def digest(batch: pa.RecordBatch) -> dict:
        sha = []
        for data, spans_of in zip(utf8(batch), batch.column("spans").to_pylist()):
            s, e = np.array([[x["start"], x["end"]] for x in spans_of], np.int64).T
            sha.append(hashlib.sha256(cut(data, unit, s, e)).hexdigest())
        return {k: batch.column(k) for k in columns} | {"kept_sha256": sha}

    torn = arrow_map(text.select(*columns, "text"), digest, f"rid bigint, doc_id bigint, xx bigint, w bigint, n bigint, n_removed bigint, spans {SPANS}, kept_sha256 string")
    out = rest.select(*columns, "kept_sha256").unionByName(torn.dropDuplicates(["rid"]))
    out = out.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    return out.withColumn("w", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int")))).drop("rid", "w")


def cleaned(docs: DataFrame, result: DataFrame, unit: str) -> DataFrame:
    """``docs`` with the texts that ``remove`` leaves, in place of the old ones."""
    key = F.xxhash64(text_or_empty())
    spans = result.filter("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("xx").alias("_xx"), F.col("spans").alias("_spans")).dropDuplicates(["_id", "_xx"])
    joined = docs.join(spans, docs.doc_id.cast("bigint").eqNullSafe(F.col("_id")) & (key == F.col("_xx")), "left")

    @F.pandas_udf("string")
    def left(text, spans_of):  # type: ignore[no-untyped-def]
        import pandas as pd

        def one(t, x):
            if x is None or not len(x):
                return t
            s, e = np.array([[y["start"], y["end"]] for y in x], np.int64).T
            return cut((t or "").encode(), unit, s, e).decode("utf-8", "replace")

        return pd.Series([one(t, x) for t, x in zip(text, spans_of)], dtype=object)

    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(left("text", "_spans"))).drop("_id", "_xx", "_spans")


def shared_runs(found: DataFrame, doc: Column | None = None, *more: str) -> DataFrame:
    """The runs as rows: rid, w, g, c, s, m, a (and doc and further columns)."""
    columns = ["rid", "w", F.explode("runs").alias("r"), *more] + ([doc.alias("doc")] if doc is not None else [])
    rest = [*more, "doc"] if doc is not None else [*more]
    return found.select(*columns).select("rid", "w", "r.*", *rest)


def spans_in(batch: pa.RecordBatch, unit: str, each: Callable[[bytes, int, np.ndarray, np.ndarray, dict], None]) -> None:
    """Call ``each(bytes of the joined text, row, first, last, work)`` with the byte edges of the units."""
    data = utf8(batch)
    work = batch.column("work").to_pylist()
    for i, (text, todo) in enumerate(zip(data, work)):
        if unit == "word":
            joined, start, end, _ = words_of([text])
            each(joined, i, start, end, todo)
        else:
            each(text, i, np.zeros(0, np.int64), np.zeros(0, np.int64), todo)
