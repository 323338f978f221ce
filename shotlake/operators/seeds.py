"""Candidate frames of shots, and how well they cover time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.scalars import inside_shot, shot_length

#: The lengths of windows that coverage is reported for.
WINDOWS = (5, 7, 9, 10, 11, 21)


def seeds(shots: DataFrame, settings: Settings) -> DataFrame:
    """video_id, shot_id, frame_idx, reasons (sorted), locator: strided, edge and inner frames of each shot."""
    stride = settings.sample_stride
    start, end, n = F.col("start_frame"), F.col("end_frame"), shot_length()
    middle = F.floor((start + end) / 2).cast("bigint")

    def one(frame, reason: str, locator: bool = False):
        return F.struct(frame.cast("bigint").alias("frame_idx"), F.lit(reason).alias("reason"), F.lit(locator).alias("locator"))

    steps = F.when(n < stride, F.array(middle)).otherwise(F.sequence(start + (stride - 1), F.greatest(end, start + (stride - 1)), F.lit(stride).cast("bigint")))
    inner = [one(start + F.bround((n - 1) * F.lit(f)).cast("bigint"), name) for f, name in ((0.25, "stable_q1"), (0.5, "stable_mid"), (0.75, "stable_q3"))]
    rest = F.when(n <= stride, F.array(one(middle, "short_shot"))).otherwise(F.array(*inner))
    every = F.concat(F.transform(steps, lambda f: one(f, "periodic", True)), F.array(one(start, "boundary_start"), one(end, "boundary_end")), rest)
    rows = shots.select("video_id", "shot_id", F.explode(every).alias("x")).select("video_id", "shot_id", "x.*")
    return rows.groupBy("video_id", "shot_id", "frame_idx").agg(F.array_sort(F.collect_set("reason")).alias("reasons"), F.bool_or("locator").alias("locator"))


def reason_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def decode_targets(rows: DataFrame, shots: DataFrame, radius: int) -> DataFrame:
    """The different frames within ``radius`` of a seed in its shot."""
    near = rows.select("video_id", "shot_id", F.explode(F.sequence(F.col("frame_idx") - radius, F.col("frame_idx") + radius)).alias("frame_idx"))
    return near.join(shots.select("video_id", "shot_id", "start_frame", "end_frame"), ["video_id", "shot_id"]).filter(inside_shot(F.col("frame_idx"))).select("video_id", "frame_idx").distinct()


def shot_coverage(shots: DataFrame, rows: DataFrame, lengths: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Per shot and length: windows inside the shot (possible) and those with a locator (covered).

    Each locator counts the windows that it covers and the one before it doesn't.
    """
    s, e, f = F.col("start_frame"), F.col("end_frame"), F.col("frame_idx")
    located = shots.join(rows.filter("locator").select("video_id", "shot_id", "frame_idx"), ["video_id", "shot_id"], "left")
    located = located.withColumn("before", F.lag("frame_idx").over(Window.partitionBy("video_id", "shot_id").orderBy("frame_idx")))
    located = located.withColumn("length", F.explode(F.array(*[F.lit(x) for x in lengths]))).withColumn("possible", shot_length() - F.col("length") + 1).filter("possible > 0")
    first = F.greatest(s, f - F.col("length") + 1, F.coalesce(F.col("before") + 1, s))
    new = F.when(f.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(e - F.col("length") + 1, f) - first + 1))  # a shot without locators covers nothing
    return located.groupBy("video_id", "shot_id", "length").agg(F.first("possible").alias("possible"), F.coalesce(F.sum(new), F.lit(0)).alias("covered"))


def window_coverage(shots: DataFrame, rows: DataFrame, lengths: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Per video and length the share of covered windows; 1 where there is no window."""
    every = shots.select("video_id").distinct().withColumn("length", F.explode(F.array(*[F.lit(x) for x in lengths])))
    sums = shot_coverage(shots, rows, lengths).groupBy("video_id", "length").agg(F.sum("covered").alias("covered"), F.sum("possible").alias("possible"))
    share = F.coalesce(F.col("covered") / F.col("possible"), F.lit(1.0))
    return every.join(sums, ["video_id", "length"], "left").select("video_id", "length", share.alias("coverage"), F.coalesce("possible", F.lit(0)).alias("weight"))


def weighted_coverage(shots: DataFrame, rows: DataFrame, lengths: tuple[int, ...] = WINDOWS) -> DataFrame:
    per = window_coverage(shots, rows, lengths)
    share = F.coalesce(F.try_divide(F.sum(F.col("coverage") * F.col("weight")), F.sum("weight")), F.lit(1.0))
    return per.groupBy("length").agg(share.alias("coverage"))


def max_gap(shots: DataFrame, rows: DataFrame) -> DataFrame:
    """Per shot the widest step between its edges and locators; its length where there is no locator."""
    located = shots.join(rows.filter("locator").select("video_id", "shot_id", "frame_idx"), ["video_id", "shot_id"], "left")
    step = F.col("frame_idx") - F.lag("frame_idx").over(Window.partitionBy("video_id", "shot_id").orderBy("frame_idx"))
    found = located.withColumn("step", step).groupBy("video_id", "shot_id", "start_frame", "end_frame").agg(F.min("frame_idx").alias("low"), F.max("frame_idx").alias("high"), F.max("step").alias("step"))
    gap = F.coalesce(F.greatest(F.col("low") - F.col("start_frame"), F.col("step"), F.col("end_frame") - F.col("high")), shot_length())
    return found.select("video_id", "shot_id", F.when(F.col("low").isNull(), shot_length()).otherwise(gap).alias("max_gap"))


def length_percentiles(shots: DataFrame) -> DataFrame:
    n = shot_length()
    qs = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    return shots.agg(F.coalesce(F.min(n), F.lit(0)).alias("least"), *[F.coalesce(F.percentile(n, q), F.lit(0.0)).alias(k) for k, q in qs.items()], F.coalesce(F.max(n), F.lit(0)).alias("most"))
