"""Near-duplicates by circulant MinHash, with exact Jaccard verification.

Two permutations of 2**20 places serve all coordinates: the first says where a
shingle stands, the second, shifted by one more place for each coordinate, gives
the value to be minimised; so the coordinates of a shingle are neighbours in one
table.  Bands of 5 values find candidates (a pair at the threshold is missed with
a probability under 1e-6).  Equal shingle sets are one class from the start, and
only classes are compared: in each bucket first with the member that shares most
buckets with others, and then, where that has not made one component, each with those of the others,
in blocks.  Every link is confirmed on the full sets.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, lookup, materialize, release, shielded, small, text_or_empty, utf8
from .components import components
from .removal import CHUNK, fetch
from .windows import chunks, mix, prefix_hash, slice_hash, word_codes, words_of

SHINGLE = 3
PERCENT = 85
PLACES = 1 << 20
BANDS = 24
ROWS = 5
SEED = 20_24
#: Coordinates of which a byte is kept to estimate a similarity, and the share of equal ones under
#: which a candidate is not verified: over four standard deviations under the threshold.
SKETCH = 480
LEAST_EQUAL = 0.78
BLOCK = 512
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@functools.cache
def _tables(seed: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    first, second = (random.permutation(PLACES).astype(np.int32) for _ in range(2))
    return first, np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:k]]), k)


def signature(shingles: np.ndarray, k: int = SKETCH, seed: int = SEED) -> np.ndarray:
    """The ``k`` coordinates of a set of 64-bit hashes."""
    first, shifted = _tables(seed, k)
    place = first[(shingles >> np.uint64(44)).astype(np.int64)]
    parts = [shifted[place[i : i + 1024]].min(axis=0) for i in range(0, len(place), 1024)]
    return parts[0] if len(parts) == 1 else np.min(parts, axis=0)


def sets(data: list[bytes], size: int):
    """The shingle sets of texts, as sorted hashes."""
    for piece in chunks([len(x) for x in data], CHUNK):
        joined, start, end, bounds = words_of([x.translate(_LOWER) for x in data[piece]])
        h = prefix_hash(word_codes(joined, start, end))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a < size:
                yield mix(slice_hash(h, np.array([a]), np.array([b]))) if b > a else np.zeros(0, np.uint64)
            else:
                at = np.arange(a, b - size + 1)
                values = np.sort(mix(slice_hash(h, at, at + size)))
                yield values[np.concatenate([[True], values[1:] != values[:-1]])]


def _features(size: int):
    salts = mix(np.arange(1, BANDS + 1, dtype=np.uint64))

    def of(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("n", "c1", "c2", "bands", "sig")}
        for s in sets(utf8(batch), size):
            out["n"].append(len(s))
            digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            out["c1"].append(int(digest[0]))
            out["c2"].append(int(digest[1]))
            if not len(s):
                out["bands"].append(None)
                out["sig"].append(None)
                continue
            values = signature(s)
            key = salts.copy()
            for column in values[: BANDS * ROWS].reshape(BANDS, ROWS).T.astype(np.uint64):
                key = mix(key ^ (column + np.uint64(1)))
            out["bands"].append(key.view(np.int64))
            out["sig"].append(values.astype(np.uint8).tobytes())
        return {k: batch.column(k) for k in ("doc_id", "xx")} | out

    return of


def _likely(batch: pa.RecordBatch) -> list[bool]:
    a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in ("sig_a", "sig_b"))
    return ((a == b).mean(axis=1) >= LEAST_EQUAL).tolist()


def _linked(percent: int):
    def of(batch: pa.RecordBatch) -> dict:
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            keep.append(_enough(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
        mask = pa.array(keep)
        return {k: batch.column(k).filter(mask) for k in ("a", "b")}

    return of


def _sets(docs: DataFrame, reps: DataFrame, rids: DataFrame, size: int) -> DataFrame:
    """The shingle sets (rid, set) of some representatives, from their texts."""
    wanted = materialize(rids.distinct().join(reps.select("rid", "doc_id", "xx"), "rid"), "wanted")

    def shingles(batch: pa.RecordBatch) -> dict:
        return {"rid": batch.column("rid"), "set": [s.tobytes() for s in sets(utf8(batch), size)]}

    of = arrow_map(fetch(docs, wanted).select("rid", "text"), shingles, "rid bigint, set binary")
    return materialize(of.dropDuplicates(["rid"]), "sets")


def _enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets overlap enough."""
    at = np.searchsorted(x, y)
    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class representatives whose sets overlap enough."""
    hot = materialize(pairs.groupBy("b").agg(F.count("*").alias("c")), "leaders")
    sides = reps.select("rid", "n", "sig")
    left = pairs.join(sides.withColumnsRenamed({"rid": "a", "n": "n_a", "sig": "sig_a"}), "a")
    right = materialize(sides.withColumnsRenamed({"rid": "b", "n": "n_b", "sig": "sig_b"}).join(hot, "b"), "leader-signatures")
    both = lookup(left, right, ["b"], "c").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def likely(batch: pa.RecordBatch) -> dict:
        mask = pa.array(_likely(batch))
        return {k: batch.column(k).filter(mask) for k in ("a", "b", "c")}

    kept = materialize(arrow_map(both.select("a", "b", "c", "sig_a", "sig_b"), likely, "a bigint, b bigint, c bigint"), "likely")
    of = _sets(docs, reps, kept.select(F.col("a").alias("rid")).unionByName(kept.select(F.col("b").alias("rid"))), size)
    # a representative with many candidates gets more copies of its set, dealt by salt
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("a"), F.expr("c div 256 + 1")))
    times = hot.withColumn("salt", F.explode(F.expr("sequence(0L, c div 256)"))).drop("c")
    ends = of.withColumnsRenamed({"rid": "b", "set": "set_b"}).join(times, "b")
    full = salted.join(of.withColumnsRenamed({"rid": "a", "set": "set_a"}), "a").join(ends, ["b", "salt"])
    return arrow_map(full.select("a", "b", "set_a", "set_b"), _linked(percent), "a bigint, b bigint")


def _likely_pairs(n, rid, comp, part, sig, bands, band, one_block, percent):
    """Likely pairs (by place, with the share of equal coordinates) of different components in a bucket.

    Of two blocks only pairs across them count, and a pair counts in the first band it shares.
    """
    found = [np.zeros((3, 0))]
    for a in range(0, len(rid), 256):
        rows = slice(a, min(a + 256, len(rid)))
        ok = (comp[rows, None] != comp[None]) & (rid[rows, None] > rid[None])
        if not one_block:
            ok &= part[rows, None] != part[None]
        ok &= np.minimum(n[rows, None], n[None]) * 100 >= np.maximum(n[rows, None], n[None]) * percent
        x, y = np.nonzero(ok)
        for b in range(0, len(x), 1 << 14):
            p, q = x[b : b + (1 << 14)] + a, y[b : b + (1 << 14)]
            first = (bands[p] == bands[q]).argmax(axis=1) == band
            p, q = p[first], q[first]
            share = (sig[p] == sig[q]).mean(axis=1)
            good = share >= LEAST_EQUAL
            found.append(np.stack([p[good], q[good], share[good]]))
    p, q, share = np.concatenate(found, axis=1)
    return p.astype(np.int64), q.astype(np.int64), share


def _links(p, q, share, comp, rid, of, percent):
    """Verified links among the likely pairs, one for each two components that meet; the likeliest are tried first."""
    parent = {}

    def top(c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    for i in np.argsort(-share, kind="stable").tolist():
        a, b = top(comp[p[i]]), top(comp[q[i]])
        if a != b and _enough(of[p[i]], of[q[i]], percent):
            parent[max(a, b)] = min(a, b)
            yield rid[p[i]], rid[q[i]]


_PLACES = ("key", "i", "j", "band", "rid", "comp", "part")
_INVOLVED = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("band", pa.int32()), ("rid", pa.int64()), ("comp", pa.int64()), ("part", pa.int32())])


def _across(percent: int, exact: bool):
    """Of the members of each bucket (or two blocks of one) that come in order: those of likely pairs, or with
    ``exact``, where they bring their sets, the verified links."""

    def solve(table: pa.Table):
        cols = {k: np.asarray(table.column(k)) for k in (*_PLACES, "n")}
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(table), -1)
        bands = np.asarray(pa.concat_arrays(table.column("bands").chunks).flatten()).reshape(len(table), -1)
        of = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()] if exact else None
        group = np.stack([cols[k] for k in ("key", "i", "j")])
        cuts = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(axis=0)]))
        involved, links = [], []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(table)]):
            if b - a > 1:
                c = {k: v[a:b] for k, v in cols.items()}
                p, q, share = _likely_pairs(c["n"], c["rid"], c["comp"], c["part"], sig[a:b], bands[a:b], c["band"][0], c["i"][0] == c["j"][0], percent)
                if exact:
                    links += _links(p, q, share, c["comp"].tolist(), c["rid"].tolist(), of[a:b], percent)
                elif len(p):
                    involved.append(a + np.unique(np.concatenate([p, q])))
        if exact:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in range(2)], ["a", "b"])
        at = np.concatenate([np.zeros(0, np.int64), *involved])
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name][at], f.type) for f in _INVOLVED], schema=_INVOLVED)

    def run(batches):
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            key, i, j = (np.asarray(table.column(k)) for k in ("key", "i", "j"))
            differs = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(differs[-1]) + 1 if len(differs) else 0  # the last group may go on in the next batch
            if cut:
                yield solve(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None:
            yield solve(kept)
        release()

    return run


def near_dedup(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_id.

    Texts without words and null texts have no shingles and are linked with
    nothing.  A null doc_id counts as larger than any other.  Of rows with the
    same smallest doc_id in a component one is kept.
    """
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("xx"))
    found = arrow_map(texts, _features(size), "doc_id bigint, xx bigint, n bigint, c1 bigint, c2 bigint, bands array<bigint>, sig binary")
    found = materialize(found.withColumn("rid", F.monotonically_increasing_id()), "minhash")
    doc = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    classes = found.filter("n > 0").groupBy("c1", "c2").agg(F.min(F.struct(doc.alias("doc"), "rid")).alias("r"), F.count("*").alias("size"))
    classes = materialize(classes.select("c1", "c2", "size", F.col("r.rid").alias("rep"), F.col("r.doc").alias("doc")), "classes")
    reps = materialize(found.join(classes.select(F.col("rep").alias("rid"), "doc"), "rid"), "representatives")

    rows = reps.select("rid", F.posexplode("bands").alias("band", "key"))
    buckets = materialize(rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "buckets")
    members = materialize(lookup(rows, buckets, ["key"], "m"), "members")
    popular = members.join(members.groupBy("rid").agg(F.sum("m").alias("popular")), "rid")
    leaders = materialize(popular.groupBy("key").agg(F.max_by("rid", "popular").alias("leader"), F.first("m").alias("m")), "bucket-leaders")
    members = materialize(lookup(members.drop("m"), leaders, ["key"], "m"), "led")
    first = members.filter("rid <> leader").select(F.col("rid").alias("a"), F.col("leader").alias("b")).distinct()
    links = materialize(_verified(docs, reps, materialize(first, "to-leaders"), size, percent), "links-1")

    joined = materialize(components(links), "components-1")
    placed = members.filter("m > 2").join(joined.withColumnRenamed("node", "rid"), "rid", "left")
    placed = materialize(placed.select("key", "band", "rid", F.coalesce("component", "rid").alias("comp")), "placed")
    open_ = placed.groupBy("key").agg(F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    open_ = materialize(open_.select("key", "m"), "open")
    blocks = F.expr(f"cast((m + {BLOCK - 1}) div {BLOCK} as int)")
    rest = lookup(placed, open_, ["key"], "m").withColumn("blocks", blocks).withColumn("part", F.expr("cast(pmod(xxhash64(rid), blocks) as int)"))
    rest = rest.join(reps.select("rid", "n", "sig", "bands"), "rid")
    rest = rest.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rest = rest.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}).select(*_PLACES, "n", "sig", "bands")
    dealt = lambda df: df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    places = "key bigint, i int, j int, band int, rid bigint, comp bigint, part int"
    involved = materialize(dealt(rest).mapInArrow(_across(percent, False), places), "involved")
    of = _sets(docs, reps, involved.select("rid"), size)
    full = involved.join(reps.select("rid", "n", "sig", "bands"), "rid").join(of, "rid").select(*_PLACES, "n", "sig", "bands", "set")
    links = joined.toDF("a", "b").unionByName(dealt(full).mapInArrow(_across(percent, True), "a bigint, b bigint"))

    joined = materialize(components(links), "components")
    least = joined.join(reps.select(F.col("rid").alias("node"), "doc"), "node").groupBy("component").agg(F.min(F.struct("doc", F.col("node").alias("rid"))).alias("m"))
    tops = joined.select("component").distinct().join(reps.select(F.col("rid").alias("component"), "doc"), "component")
    least = least.join(tops, "component").select("component", F.least(F.col("m"), F.struct("doc", F.col("component").alias("rid"))).alias("m"), F.lit(1).alias("one"))
    named = joined.unionByName(tops.select(F.col("component").alias("node"), "component"))
    sizes = named.groupBy("component").agg(F.count("*").alias("members"))
    least = materialize(least.join(sizes, "component").select("component", "members", F.col("m.doc").alias("least_doc"), F.col("m.rid").alias("least_rid")), "least")
    named = lookup(named, least, ["component"], "members").select(F.col("node").alias("rep"), "least_doc", "least_rid")
    classes = classes.join(named, "rep", "left").select("c1", "c2", "size", "rep", F.coalesce("least_doc", "doc").alias("least_doc"), F.coalesce("least_rid", "rep").alias("least_rid"))
    classes = materialize(classes, "classes-named")
    full = lookup(found.filter("n > 0").select("rid", "doc_id", "n", "c1", "c2", "xx"), classes, ["c1", "c2"], "size")
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.when(F.col("least_doc") < (1 << 63) - 1, F.col("least_doc")).alias("component_id"), (F.col("rid") == F.col("least_rid")).alias("kept"), F.col("rep").alias("class_id"), "rid", "xx"]
    alone = found.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.col("rid").alias("class_id"), "rid", "xx")
    return full.select(*columns).unionByName(alone)


@shielded
def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component (of repeated rows one stays)."""
    result = materialize(near_dedup(docs), "near-result")
    key = F.xxhash64(text_or_empty())
    one = result.groupBy("doc_id", "xx").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = materialize(one.filter("not kept or n > 1"), "near-dropped")
    marks = gone.select(F.col("doc_id").alias("_id"), F.col("xx").alias("_xx"), F.col("kept").alias("_kept"))
    joined = docs.join(small(marks), docs.doc_id.cast("bigint").eqNullSafe(F.col("_id")) & (key == F.col("_xx")), "left")
    once = joined.filter("_kept").dropDuplicates(["_id", "_xx"])
    return joined.filter("_xx is null").unionByName(once).select(*docs.columns)
