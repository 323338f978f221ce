"""Changes within shots, better neighbours, and duplicates by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.scalars import hamming

SHOT = ["video_id", "shot_id"]
FRAME = [*SHOT, "frame_idx"]
SIGNALS = {"appearance": "appearance_change", "motion": "motion_change", "text": "text_change"}


def signals(rows: DataFrame) -> DataFrame:
    """``rows`` with metrics, and their change from the row before them in the shot (null for the first)."""
    before = Window.partitionBy(*SHOT).orderBy("frame_idx")
    was = lambda c: F.lag(c).over(before)
    return rows.withColumns({
        "appearance": hamming(F.col("dhash"), was("dhash")) / F.lit(64.0),
        "motion": F.abs(F.col("luma_std") - was("luma_std")) / F.lit(255.0),
        "text": F.abs(F.col("text_proxy") - was("text_proxy")),
    })


def thresholds(changes: DataFrame, settings: Settings) -> DataFrame:
    """Per shot and signal: median plus the scaled median absolute deviation."""
    scale = {"appearance": settings.appearance_mad_scale, "motion": settings.motion_mad_scale, "text": settings.text_mad_scale}
    middle = changes.groupBy(*SHOT).agg(*[F.median(k).alias(f"m_{k}") for k in scale])
    apart = changes.join(middle, SHOT).groupBy(*SHOT).agg(*[F.first(f"m_{k}").alias(f"m_{k}") for k in scale], *[F.median(F.abs(F.col(k) - F.col(f"m_{k}"))).alias(f"d_{k}") for k in scale])
    return apart.select(*SHOT, *[(F.col(f"m_{k}") + F.lit(float(s)) * F.greatest(F.col(f"d_{k}"), F.lit(1e-9))).alias(f"t_{k}") for k, s in scale.items()])


def change_flags(rows: DataFrame, settings: Settings) -> DataFrame:
    """Keys and flags (sorted names of the signals that reach their threshold) of rows with metrics."""
    changes = signals(rows)
    flags = F.array_compact(F.array(*[F.when(F.col(k) >= F.col(f"t_{k}"), F.lit(name)) for k, name in SIGNALS.items()]))
    return changes.join(thresholds(changes, settings), SHOT, "left").select(*FRAME, F.array_sort(flags).alias("flags"))


def rescues(rows: DataFrame, metrics: DataFrame, settings: Settings) -> DataFrame:
    """Better neighbours of locators: keys and gain.

    ``rows`` are seeds with metrics; ``metrics`` all decoded frames.  The neighbours
    are found by equality on the frames within the radius, not by a range join.
    """
    r = settings.neighbor_radius
    located = rows.filter("locator").select(*SHOT, F.col("frame_idx").alias("origin"), F.col("quality_score").alias("was"))
    near = located.withColumn("frame_idx", F.explode(F.sequence(F.col("origin") - r, F.col("origin") + r)))
    valid = metrics.filter("not hard_invalid").select(*FRAME, "quality_score")
    better = near.join(valid, FRAME).filter("quality_score > was")
    best = better.groupBy(*SHOT, "origin", "was").agg(F.max(F.struct("quality_score", (-F.col("frame_idx")).alias("back"))).alias("b"))
    gain = F.col("b.quality_score") - F.col("was")
    found = best.select(*SHOT, (-F.col("b.back")).alias("frame_idx"), gain.alias("gain")).filter(F.col("gain") >= settings.rescue_min_gain)
    found = found.groupBy(*FRAME).agg(F.max("gain").alias("gain"))
    most = located.groupBy(*SHOT).agg(F.ceil(F.count("*") * F.lit(settings.max_rescue_fraction)).alias("most"))
    place = F.row_number().over(Window.partitionBy(*SHOT).orderBy(F.desc("gain"), "frame_idx"))
    return found.withColumn("place", place).join(most, SHOT).filter("place <= most").select(*FRAME, "gain")


def cheap_duplicates(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rejected`` of each row after one pass in frame order.

    ``rows`` has rejected (null, decode_missing or hard_invalid), dhash, locator and
    hard_keep.  A row is a duplicate of the last row that was not rejected if both
    are near in time and in hash.  The pass depends on its own decisions, so each
    shot is folded as an array (shots are short).
    """
    item = F.struct("frame_idx", "dhash", "rejected", (F.col("locator") | F.col("hard_keep")).alias("keep"))
    state = F.struct(F.lit(None).cast("bigint").alias("frame"), F.lit(None).cast("bigint").alias("hash"), F.array().cast("array<struct<frame_idx:bigint,rejected:string>>").alias("out"))

    def step(s, x):
        close = (x["frame_idx"] - s["frame"] <= settings.cluster_radius) & (hamming(x["dhash"], s["hash"]) <= settings.dhash_duplicate_distance)
        same = F.coalesce(close, F.lit(False)) & ~x["keep"]
        verdict = F.when(same, F.lit("cheap_duplicate")).otherwise(x["rejected"])
        kept = verdict.isNull()
        return F.struct(
            F.when(kept, x["frame_idx"]).otherwise(s["frame"]).alias("frame"),
            F.when(kept, x["dhash"]).otherwise(s["hash"]).alias("hash"),
            F.concat(s["out"], F.array(F.struct(x["frame_idx"].alias("frame_idx"), verdict.alias("rejected")))).alias("out"),
        )

    folded = rows.groupBy(*SHOT).agg(F.array_sort(F.collect_list(item)).alias("items"))
    out = folded.select(*SHOT, F.explode(F.aggregate("items", state, step, lambda s: s["out"])).alias("x"))
    return out.select(*SHOT, "x.frame_idx", "x.rejected")


def enriched(seed_rows: DataFrame, metrics: DataFrame, settings: Settings) -> DataFrame:
    """Seeds with metrics, change reasons, rescued neighbours and rejections."""
    measured = seed_rows.join(metrics, FRAME, "left")
    known = measured.filter("quality_score is not null")
    flags = change_flags(known, settings)
    saved = rescues(known, metrics, settings).select(*FRAME, F.lit(True).alias("rescued"))
    rows = seed_rows.join(flags, FRAME, "left").join(saved, FRAME, "full").join(metrics, FRAME, "left")
    none = F.array().cast("array<string>")
    reasons = F.array_union(F.array_union(F.coalesce("reasons", none), F.coalesce("flags", none)), F.when(F.col("rescued"), F.array(F.lit("quality_rescue"))).otherwise(none))
    rejected = F.when(F.col("quality_score").isNull(), F.lit("decode_missing")).when(F.col("hard_invalid"), F.lit("hard_invalid"))
    rows = rows.withColumns({"reasons": F.array_sort(reasons), "locator": F.coalesce("locator", F.lit(False)), "hard_keep": F.coalesce("rescued", F.lit(False)), "rejected": rejected, "cluster_id": F.expr(f"frame_idx div {settings.cluster_radius}")}).drop("flags", "rescued")
    verdict = cheap_duplicates(rows, settings)
    return rows.drop("rejected").join(verdict, FRAME)
