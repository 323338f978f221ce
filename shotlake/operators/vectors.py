"""Vectors of candidates: similar neighbours, duplicates, checks, gathering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.scalars import dot, norm, normalized

SHOT = ["video_id", "shot_id"]
FRAME = [*SHOT, "frame_idx"]


def similar_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of a shot's frames (earlier, frame_idx) within the window and at the cosine or above.

    Frames fall into cells as long as the window, so partners are in the same cell
    or the one before: an equality join, whatever the length of the shot.
    """
    w = settings.semantic_local_window
    unit = rows.select(*FRAME, normalized(F.col("embedding")).alias("unit")).withColumn("cell", F.expr(f"frame_idx div {w}"))
    before = unit.select(*SHOT, F.col("frame_idx").alias("earlier"), F.col("unit").alias("other"), F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"))
    near = unit.join(before, [*SHOT, "cell"]).filter((F.col("frame_idx") > F.col("earlier")) & (F.col("frame_idx") - F.col("earlier") <= w))
    cosine = dot(F.col("unit"), F.col("other"))
    return near.withColumn("cosine", cosine).filter(F.col("cosine") >= settings.semantic_duplicate_cosine).select(*SHOT, "earlier", "frame_idx", "cosine")


def semantic_duplicates(rows: DataFrame, settings: Settings) -> DataFrame:
    """Keys of rows that repeat a kept earlier row of their shot.

    ``rows`` has embedding, rejected, locator, hard_keep.  Rejected rows neither
    repeat nor are repeated; locators and rescued rows always stay.  Pairs are
    found in parallel, only the decisions go through a shot in order.
    """
    live = rows.filter("rejected is null")
    repeats = similar_pairs(live, settings).groupBy(*FRAME).agg(F.collect_list("earlier").alias("earlier"))
    item = F.struct("frame_idx", (F.col("locator") | F.col("hard_keep")).alias("keep"), F.coalesce("earlier", F.array().cast("array<bigint>")).alias("earlier"))
    items = live.join(repeats, FRAME, "left").groupBy(*SHOT).agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.array().cast("array<bigint>")

    def step(s, x):
        gone = ~x["keep"] & F.arrays_overlap(s["kept"], x["earlier"])
        one = F.array(x["frame_idx"])
        return F.struct(F.when(gone, s["kept"]).otherwise(F.concat(s["kept"], one)).alias("kept"), F.when(gone, F.concat(s["gone"], one)).otherwise(s["gone"]).alias("gone"))

    gone = F.aggregate("items", F.struct(none.alias("kept"), none.alias("gone")), step, lambda s: s["gone"])
    return items.select(*SHOT, F.explode(gone).alias("frame_idx"))


def integrity(rows: DataFrame, vectors: DataFrame, settings: Settings) -> DataFrame:
    """One row: counts, norms and failures of the vectors that belong to ``rows`` (video_id, frame_idx)."""
    keys = ["video_id", "frame_idx"]
    size = norm(F.col("embedding"))
    of = rows.select(*keys).withColumn("wanted", F.lit(True)).join(vectors.select(*keys, size.alias("norm"), F.size("embedding").alias("dim")), keys, "full")
    dim = settings.embedding_dim
    stats = of.agg(
        F.count("norm").alias("vectors"), F.count_if(F.col("norm").isNull()).alias("missing"), F.count_if(F.col("wanted").isNull()).alias("unexpected"), F.count_if(F.col("dim") != dim).alias("wrong_dim"),
        F.count_if(F.isnan("norm") | (F.col("norm") == float("inf"))).alias("not_finite"), F.count_if(F.abs(F.col("norm") - 1) > 2e-3).alias("not_unit"),
        *[F.coalesce(f("norm"), F.lit(0.0)).alias(f"norm_{k}") for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg))],
    )
    bad = [F.when(F.col(c) > 0, F.lit(c)) for c in ("missing", "unexpected", "wrong_dim", "not_finite", *(["not_unit"] if settings.normalize_vectors else []))]
    return stats.withColumn("failures", F.array_compact(F.array(*bad)))


def gathered(vectors: DataFrame, selected: DataFrame) -> DataFrame:
    """The selected vectors with a digest of their bytes, which has to stay the same wherever they are copied."""
    return vectors.join(selected.select("video_id", "frame_idx"), ["video_id", "frame_idx"], "left_semi").withColumn("sha256", F.sha2("emb_f16", 256))


def same_bytes(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Keys whose bytes differ between two stores, or that the source hasn't."""
    s = source.select("video_id", "frame_idx", F.sha2("emb_f16", 256).alias("was"))
    return copy.select("video_id", "frame_idx", F.sha2("emb_f16", 256).alias("sha")).join(s, ["video_id", "frame_idx"], "left").filter(~F.col("sha").eqNullSafe(F.col("was"))).select("video_id", "frame_idx")


def nearest(index: DataFrame, query: list[float], k: int) -> DataFrame:
    """The ``k`` vectors of the index with the largest cosine to the query (beyond the reference: a plain scan)."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return index.withColumn("cosine", dot(normalized(F.slice("embedding", 1, len(query))), normalized(q))).orderBy(F.desc("cosine"), "video_id", "frame_idx").limit(k)
