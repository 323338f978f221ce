"""Incremental substring dedup over a log-structured fingerprint index.

Every window of 50 words is represented by its anchor run (see ``windows``): the
index holds, per (anchor hash ``g``, hash ``c`` of all the run's words), the first
document and place.  Where one anchor stands in different surroundings, the index
also holds the hashes of the single windows.  A batch of documents is merge-joined
with the runs of the log, each sorted by fingerprint within hash partitions; every
hit is verified on the words themselves, in the batch's document and in the older
one; then the batch's fingerprints become one more immutable run, and when more than
``FAN`` runs have gathered they are compacted into one, in which a fingerprint keeps
its first document.  What came in an earlier batch, or in a smaller document of the
same batch, stays; batches in the order of doc_id give the same as one.

Nulls and texts without words give no windows; a null doc_id counts as larger than
any other, and rows with equal ids never remove words from each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, delete, discard, lookup, materialize, scratch, shielded, utf8, written
from .removal import cleaned, features, fetch, remove, shared_runs
from .windows import merged, prefix_hash, slice_hash, word_codes, words_of

WORDS = 50
GRAM = 12
#: Batches in which a table is gone through, and runs of the log that are not compacted yet.
BATCHES = 2
FAN = 1
#: Stands for a null doc_id, behind all others.
LAST = (1 << 63) - 1
#: Spans of one older document that are verified at once.
TOGETHER = 1024
WORK = "array<struct<s:int,m:int,new:boolean>>"
ANCHORS = "g bigint, c bigint, doc bigint, xx bigint, s int, m int, n bigint"
WINDOWS = "w bigint, v bigint, doc bigint, xx bigint, s int, n bigint"


def _doc_id() -> Column:
    return F.when(F.col("doc") < LAST, F.col("doc")).alias("doc_id")


def _firsts(rows: DataFrame, keys: list[str], more: list[str]) -> DataFrame:
    """Of each fingerprint the first place, and the number of places."""
    at = F.min(F.struct("doc", "xx", "s", *more)).alias("at")
    return rows.groupBy(*keys).agg(at, F.sum("n").alias("n")).select(*keys, *[F.col(f"at.{k}").alias(k) for k in ("doc", "xx", "s", *more)], "n")


class FingerprintIndex:
    """Two logs of sorted immutable runs, of anchors and of windows.

    Below ``root``, a folder that all executors share, runs and the list of the live
    ones stay and are opened again; without one they are scratch tables, and a run goes
    when it has been compacted.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fan: int = FAN, words: int = WORDS) -> None:
        self.spark, self.lasting, self.fan, self.words = spark, root is not None, fan, words
        self.root = root.rstrip("/") if root is not None else scratch(spark, "index")
        self.logs: dict[str, list[DataFrame]] = {"anchors": [], "windows": []}
        self.names: dict[str, list[str]] = {"anchors": [], "windows": []}
        self.version = 0
        if self.lasting and self._exists(f"{self.root}/live"):
            live = spark.read.schema("version int, anchors array<string>, windows array<string>").json(f"{self.root}/live/*")
            now = live.orderBy(F.desc("version")).first()
            self.version = now.version
            for name, schema in (("anchors", ANCHORS), ("windows", WINDOWS)):
                self.names[name] = list(now[name])
                self.logs[name] = [spark.read.schema(schema).parquet(f"{self.root}/{x}") for x in now[name]]

    def _exists(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _store(self, name: str, rows: DataFrame) -> tuple[str, DataFrame]:
        run = f"{name}-{self.version + 1}-{len(self.logs[name])}"
        rows.sortWithinPartitions(*rows.columns[:2]).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{run}")
        return run, self.spark.read.schema(rows.schema).parquet(f"{self.root}/{run}")

    def _append(self, name: str, rows: DataFrame) -> None:
        """One more run; too many are compacted into one, where equal fingerprints keep their first place."""
        run, stored = self._store(name, rows)
        self.logs[name].append(stored)
        self.names[name].append(run)
        if len(self.logs[name]) > self.fan:
            run, stored = self._store(name, _firsts(self._all(name), rows.columns[:2], ["m"] if name == "anchors" else []))
            for old in [] if self.lasting else self.names[name]:
                delete(self.spark, f"{self.root}/{old}")
            self.logs[name], self.names[name] = [stored], [run]

    def _all(self, name: str) -> DataFrame:
        union = self.logs[name][0]
        for run in self.logs[name][1:]:
            union = union.unionByName(run)
        return union

    def _met(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame | None:
        """What the log has under the keys of ``rows``, a place for each fingerprint."""
        if not self.logs[name]:
            return None
        found = self._all(name).join(rows.select(*keys).distinct(), keys, "left_semi")
        return _firsts(found, found.columns[:2], ["m"] if name == "anchors" else [])

    def add(self, found: DataFrame, docs: DataFrame) -> DataFrame:
        """Ranges (rid, s, e) of words of a batch that earlier documents have; the batch joins the index.

        ``found`` has the batch's features; ``docs`` the documents of this and all earlier batches.
        """
        begin = written()
        anchors = shared_runs(found, F.coalesce("doc_id", F.lit(LAST)), "xx")
        new = materialize(_firsts(anchors.withColumn("n", F.lit(1).cast("bigint")), ["g", "c"], ["m"]), "batch-anchors")
        old = self._met("anchors", new, ["g"])
        columns = ["g", "c", *[F.col(k).alias(f"old_{k}") for k in ("doc", "xx", "s", "m")]]
        old = old.select(*columns) if old is not None else new.limit(0).select(*columns)
        both = materialize(new.join(old, ["g", "c"], "full"), "batch-both")
        groups = both.groupBy("g").agg(F.count("*").alias("k"), F.count("old_s").alias("k_old"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
        groups = materialize(groups.filter("all + k_old > 1 and all > 0").drop("all"), "batch-groups")
        both = materialize(lookup(both, groups, ["g"], "k"), "batch-classes")
        mine = both.filter("n is not null").withColumnsRenamed({"doc": "first_doc", "xx": "first_xx", "s": "first_s"}).drop("m", "old_m")
        mine = materialize(lookup(anchors.drop("w", "a"), mine, ["g", "c"], "n"), "batch-hits")

        # runs whose words an older run has all
        owner = lambda k: F.coalesce(f"old_{k}", f"first_{k}").alias(f"o_{k}")
        hits = mine.filter("old_s is not null or doc > first_doc").select("rid", "s", "m", owner("doc"), owner("xx"), owner("s"))
        # others share single windows with runs that differ elsewhere; those of the index join them when their anchor has only now a second surrounding
        edges = mine.filter("old_s is null and doc = first_doc and k > 1").select("doc", "xx", "s", "m", F.lit(True).alias("new"))
        late = both.filter("old_s is not null and k > 1 and k_old = 1").select(*[F.col(f"old_{k}").alias(k) for k in ("doc", "xx", "s", "m")], F.lit(False).alias("new"))
        work = edges.unionByName(late).groupBy("doc", "xx").agg(F.collect_list(F.struct("s", "m", "new")).cast(WORK).alias("work"))
        work = materialize(work.withColumn("doc_id", _doc_id()), "batch-edges")
        text = fetch(docs, work).select("text", "doc", "xx", "work")
        windows = materialize(arrow_map(text, _windows(self.words), "w bigint, v bigint, doc bigint, xx bigint, s int, new boolean"), "batch-windows")
        known = self._met("windows", windows, ["w", "v"])
        firsts = _firsts(windows.withColumn("n", F.lit(1).cast("bigint")), ["w", "v"], [])
        every = firsts.unionByName(known) if known is not None else firsts
        owners = _firsts(every, ["w", "v"], []).select("w", "v", *[F.col(k).alias(f"o_{k}") for k in ("doc", "xx", "s")], "n")
        owners = materialize(owners.filter("n > 1"), "batch-owners")
        rids = found.select("rid", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "xx")
        single = lookup(windows.filter("new"), owners, ["w", "v"], "n").filter("doc > o_doc").join(rids, ["doc", "xx"])
        hits = hits.unionByName(single.select("rid", "s", F.lit(1).alias("m"), "o_doc", "o_xx", "o_s"))

        ranges = materialize(self._verified(docs, found, hits), "batch-ranges")
        self._append("anchors", new.select("g", "c", "doc", "xx", "s", "m", "n"))
        self._append("windows", firsts.select("w", "v", "doc", "xx", "s", "n"))
        discard(begin, "batch-ranges")
        self.version += 1
        if self.lasting:
            rows = [(self.version, self.names["anchors"], self.names["windows"])]
            live = self.spark.createDataFrame(rows, "version int, anchors array<string>, windows array<string>")
            live.coalesce(1).write.mode("overwrite").json(f"{self.root}/live/{self.version}")
        return ranges

    def _verified(self, docs: DataFrame, found: DataFrame, hits: DataFrame, joined: bool = True) -> DataFrame:
        """Ranges (rid, s, e) of the hits (rid, s, m, o_doc, o_xx, o_s) whose words are those of the older document.

        Hits that go on in the same older document at the same distance are one span;
        where its words differ, its hits are looked at one by one.
        """
        spans = hits.groupBy("rid").agg(F.collect_list(F.struct("s", "m", "o_doc", "o_xx", "o_s")).alias("hits")).join(found.select("rid", "doc_id", "xx"), "rid")
        spans = arrow_map(spans, _spans(self.words, joined), "rid bigint, doc_id bigint, xx bigint, spans array<struct<s:bigint,e:bigint,o_doc:bigint,o_xx:bigint,o_s:bigint>>")
        spans = materialize(spans, "batch-spans")
        mine = arrow_map(fetch(docs, spans).select("text", "rid", "spans"), _digests_of_spans, "rid bigint, s bigint, e bigint, o_doc bigint, o_xx bigint, o_s bigint, mine binary")
        mine = materialize(mine.distinct().withColumn("o_e", F.expr("o_s + e - s")), "batch-words")
        older = materialize(mine.groupBy("o_doc", "o_xx", "o_s", "o_e").agg(F.count("*").alias("n")), "batch-older")
        many = older.groupBy("o_doc", "o_xx").agg(F.expr(f"count(*) div {TOGETHER} + 1").alias("parts"), F.count("*").alias("spans"))
        want = lookup(older, materialize(many, "batch-many"), ["o_doc", "o_xx"], "spans").withColumn("part", F.expr("pmod(xxhash64(o_s, o_e), parts)"))
        want = want.groupBy(F.col("o_doc").alias("doc"), F.col("o_xx").alias("xx"), "part").agg(F.collect_list(F.struct(F.col("o_s").alias("s"), F.col("o_e").alias("e"), "n")).alias("spans"))
        want = materialize(want.withColumn("doc_id", _doc_id()), "batch-wanted")
        theirs = arrow_map(fetch(docs, want).select("text", "doc", "xx", "spans"), _digests_of_places, "doc bigint, xx bigint, s bigint, e bigint, n bigint, theirs binary")
        theirs = materialize(theirs.distinct().withColumnsRenamed({"doc": "o_doc", "xx": "o_xx", "s": "o_s", "e": "o_e"}), "batch-older-words")
        checked = lookup(mine, theirs, ["o_doc", "o_xx", "o_s", "o_e"], "n").withColumn("good", F.expr("mine = theirs"))
        checked = materialize(checked.drop("mine", "theirs", "n", "o_e"), "batch-checked")
        bad = checked.filter("not good")
        good = checked.filter("good").select("rid", "s", "e")
        if not joined or bad.isEmpty():
            return good
        bad = bad.select("rid", "o_doc", "o_xx", F.expr("o_s - s").alias("shift"), F.col("s").alias("low"), F.col("e").alias("high"))
        again = hits.withColumn("shift", F.expr("cast(o_s as bigint) - s")).join(bad, ["rid", "o_doc", "o_xx", "shift"]).filter("s >= low and s < high")
        return good.unionByName(self._verified(docs, found, materialize(again.select(*hits.columns), "batch-doubtful"), False))


def _windows(words: int):
    """Two hashes of each window of the runs asked for."""

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list[np.ndarray]] = {k: [] for k in ("w", "v", "doc", "xx", "s", "new")}
        for text, doc, xx, work in zip(utf8(batch), *[batch.column(k).to_pylist() for k in ("doc", "xx", "work")]):
            joined, start, end, _ = words_of([text])
            h = prefix_hash(word_codes(joined, start, end))
            at = np.concatenate([np.arange(x["s"], x["s"] + x["m"]) for x in work])
            new = np.concatenate([np.full(x["m"], x["new"]) for x in work])
            view = memoryview(joined)
            exact = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start[at].tolist(), end[at + words - 1].tolist())]
            values = (np.array(exact, np.uint64).view(np.int64), slice_hash(h, at, at + words).view(np.int64), np.full(len(at), doc), np.full(len(at), xx), at.astype(np.int32), new)
            for k, v in zip(out, values):
                out[k].append(v)
        return {k: np.concatenate(v) for k, v in out.items()}

    return of


def _spans(words: int, joined: bool):
    """Each document's hits as spans of words."""

    def of(batch: pa.RecordBatch) -> dict:
        out = []
        for hits in batch.column("hits").to_pylist():
            by: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
            for x in hits:
                by.setdefault((x["o_doc"], x["o_xx"], x["o_s"] - x["s"]), []).append((x["s"], x["s"] + x["m"] + words - 1))
            spans = []
            for (doc, xx, shift), ranges in by.items():
                starts, ends = merged(*np.array(ranges, np.int64).T) if joined else np.array(sorted(set(ranges)), np.int64).T
                spans += [{"s": s, "e": e, "o_doc": doc, "o_xx": xx, "o_s": s + shift} for s, e in zip(starts.tolist(), ends.tolist())]
            out.append(spans)
        return {k: batch.column(k) for k in ("rid", "doc_id", "xx")} | {"spans": out}

    return of


def _digests_of_spans(batch: pa.RecordBatch) -> dict:
    return _digests(batch, ["rid"], ["o_doc", "o_xx", "o_s"], "mine")


def _digests_of_places(batch: pa.RecordBatch) -> dict:
    return _digests(batch, ["doc", "xx"], ["n"], "theirs")


def _digests(batch: pa.RecordBatch, of_row: list[str], of_span: list[str], name: str) -> dict:
    """SHA-256 of the words of each span, joined by spaces."""
    out: dict[str, list] = {k: [] for k in (*of_row, "s", "e", *of_span, name)}
    for i, (text, spans) in enumerate(zip(utf8(batch), batch.column("spans").to_pylist())):
        joined, start, end, _ = words_of([text])
        view = memoryview(joined)
        for x in spans:
            words = view[start[x["s"]] : end[x["e"] - 1]] if x["e"] <= len(start) else b""
            for k, v in x.items():
                out[k].append(v)
            out[name].append(hashlib.sha256(words).digest())
        for k in of_row:
            out[k] += [batch.column(k)[i].as_py()] * len(spans)
    return out


def substring_dedup(docs: DataFrame, words: int = WORDS, gram: int = GRAM, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, xx, n (words), n_removed, spans (of words), kept_sha256.

    A word goes if a window of ``words`` words that covers it also starts in a
    document with a smaller doc_id.  The table goes through a new index in batches, in
    the order of doc_id.  An empty table gives an empty one; a text of any length is
    worked on whole.
    """
    found = features(docs, "word", words, gram)
    doc = F.coalesce("doc_id", F.lit(LAST))
    low, high = found.agg(F.min(doc), F.max(F.col("doc_id"))).first()
    index, ranges = FingerprintIndex(docs.sparkSession, fan=fan, words=words), None
    cuts = sorted({low + (high - low) * i // batches for i in range(1, batches)}) if high is not None else []
    for a, b in zip([None, *cuts], [*cuts, None]):
        batch = found.filter(F.lit(True) if a is None else doc > a).filter(F.lit(True) if b is None else doc <= b)
        some = index.add(batch, docs)
        ranges = some if ranges is None else ranges.unionByName(some)
    return remove(docs, found, ranges, "word")


@shielded
def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages."""
    return cleaned(docs, substring_dedup(docs), "word")
