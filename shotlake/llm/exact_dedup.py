"""Exact dedup by an exchange of Golomb-coded fingerprints.

Each partition sends its sorted distinct 48-bit fingerprints, Golomb-coded, to the
owners of the hash ranges; an owner answers with a bitmap that marks those it got
twice.  Only texts with a marked fingerprint (suspects) are then compared byte by
byte, by grouping on the very text, which combines copies before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golomb
from .common import lookup, materialize, shielded, small, text_or_empty

BITS = 48
#: Fingerprints that one owner should hold.
PER_OWNER = 1 << 20
LEAST_OWNERS = 8


def _range(owner: int, owners: int) -> tuple[int, int]:
    low, high = (-(-(x << BITS) // owners) for x in (owner, owner + 1))
    return low, high - low


def _send(owners: int):
    """A partition's fingerprints as one coded run per owner; ``again`` marks those it has twice itself."""

    def run(batches):
        parts = [np.asarray(b.column(0)) for b in batches]
        values, counts = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        sender = TaskContext.get().partitionId()
        owner = (values * owners) >> BITS
        cuts = np.flatnonzero(np.diff(owner, prepend=-1)) if len(values) else []
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(values)]):
            o = int(owner[a])
            rows.append((sender, o, int(b - a), golomb.encode(values[a:b], *_range(o, owners)), np.packbits(counts[a:b] > 1).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["sender", "owner", "n", "code", "again"])

    return run


def _answer(owners: int):
    """An owner's bitmaps: which of a sender's fingerprints stand twice or more in all."""

    def of(runs: pd.DataFrame) -> pd.DataFrame:
        low, span = _range(int(runs["owner"].iloc[0]), owners)
        got = [golomb.decode(c, n, low, span) for c, n in zip(runs["code"], runs["n"])]
        again = [np.unpackbits(np.frombuffer(x, np.uint8))[:n].astype(bool) for x, n in zip(runs["again"], runs["n"])]
        values = np.sort(np.concatenate(got))
        twice = np.unique(values[1:][values[1:] == values[:-1]])
        marks = []
        for x, own in zip(got, again):
            at = np.searchsorted(twice, x)
            hit = own.copy()
            inside = at < len(twice)
            hit[inside] |= twice[at[inside]] == x[inside]
            marks.append(np.packbits(hit).tobytes() if hit.any() else None)
        return runs[["sender", "owner"]].assign(marks=marks)

    return of


def _receive(owners: int):
    """The marked fingerprints of the senders' runs."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values = golomb.decode(row["code"], row["n"], *_range(row["owner"], owners))
                yield pa.RecordBatch.from_arrays([pa.array(values[np.unpackbits(np.frombuffer(row["marks"], np.uint8))[: row["n"]] > 0])], ["fp"])

    return run


def suspects(prints: DataFrame, owners: int) -> DataFrame:
    """The fingerprints (column fp) that stand twice or more."""
    runs = materialize(prints.select("fp").mapInArrow(_send(owners), "sender int, owner int, n int, code binary, again binary"), "golomb-runs")
    answers = runs.groupBy("owner").applyInPandas(_answer(owners), "sender int, owner int, marks binary")
    marked = runs.join(answers.filter("marks is not null"), ["sender", "owner"]).select("owner", "n", "code", "marks")
    return marked.mapInArrow(_receive(owners), "fp bigint").distinct()


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts are equal to empty ones.  Of equal texts the row with the largest
    doc_id stays (any id before null); of repeated rows one stays.  A pair of texts
    that agree in their hashes but not in their bytes would both stay.
    """
    text = text_or_empty()
    sha = F.sha2(text, 256)
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), sha.alias("text_sha256"), F.xxhash64(text).alias("xx"), F.conv(F.substring(sha, 1, 12), 16, 10).cast("bigint").alias("fp")]
    meta = materialize(docs.select(*columns).withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    rows = meta.count()
    found = materialize(suspects(meta, max(LEAST_OWNERS, -(-rows // PER_OWNER))), "suspects")
    few = small(found)
    key = ["text_sha256", "xx"]
    texts = docs.select(*columns[1:], text.alias("text")).join(few, "fp", "left_semi")
    checked = texts.groupBy(*key, "text").agg(F.count("*").alias("n"))
    checked = checked.groupBy(*key).agg(F.count("*").alias("texts"), F.sum("n").alias("n")).filter("texts = 1 and n > 1").drop("texts")
    best = meta.join(few, "fp", "left_semi").groupBy(*key).agg(F.max(F.struct("doc_id", (-F.col("rid")).alias("back"))).alias("best"))
    groups = materialize(checked.join(best, key).select(*key, "n", F.col("best.doc_id").alias("keep_id"), (-F.col("best.back")).alias("keep_rid")), "copies")
    joined = lookup(meta, groups, key, "n", "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        "text_sha256",
        "rid",
        "xx",
    )


@shielded
def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text: all columns, the rows that ``exact_dedup`` keeps.

    Rows are found again by (doc_id, hash of the text); of repeated rows one stays.
    """
    result = exact_dedup(docs)
    gone = materialize(result.filter("not kept").join(result.filter("kept").select(F.col("doc_id").alias("_i"), F.col("xx").alias("_h")), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("xx") == F.col("_h")), "left").select("doc_id", "xx", F.col("_h").isNotNull().alias("_repeated")).distinct(), "dropped")
    key = F.xxhash64(text_or_empty())
    marks = small(gone.select(F.col("doc_id").alias("_id"), F.col("xx").alias("_xx"), "_repeated"))
    joined = docs.join(marks, docs.doc_id.cast("bigint").eqNullSafe(F.col("_id")) & (key == F.col("_xx")), "left")
    once = joined.filter("_repeated").dropDuplicates(["_id", "_xx"])
    return joined.filter("_xx is null").unionByName(once).select(*docs.columns)
