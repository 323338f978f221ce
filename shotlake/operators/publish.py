"""The flat index, its audit, and the state of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyframes(views: DataFrame, shots: DataFrame, videos: DataFrame) -> DataFrame:
    """Discovery rows with their 1-based rank n in the video and their time in seconds."""
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("frame_idx"))
    rows = views.filter("discovery").withColumn("n", n.cast("bigint"))
    rows = rows.join(shots.select("video_id", "shot_id", F.col("start_frame").alias("shot_start_frame"), F.col("end_frame").alias("shot_end_frame")), ["video_id", "shot_id"])
    return rows.join(videos.select("video_id", "fps"), "video_id").select("video_id", "n", "frame_idx", "shot_id", "shot_start_frame", "shot_end_frame", "fps", (F.col("frame_idx") / F.col("fps")).alias("pts_time"))


def ranges(rows: DataFrame) -> DataFrame:
    """Each video's rows [begin, finish) in the index, videos in order: a running sum over one count per video."""
    counts = rows.groupBy("video_id").agg(F.count("*").alias("n"))
    finish = F.sum("n").over(Window.orderBy("video_id").rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("finish", finish).select("video_id", (F.col("finish") - F.col("n")).alias("begin"), "finish")


def flat_index(rows: DataFrame) -> DataFrame:
    """``rows`` with row_id, their place in the index."""
    return rows.join(ranges(rows), "video_id").withColumn("row_id", F.col("begin") + F.col("n") - 1).drop("begin", "finish")


def missing(expected: DataFrame, done: DataFrame) -> DataFrame:
    return expected.select("video_id").join(done, "video_id", "left_anti")


def audit(checkpoints: DataFrame, actual: DataFrame) -> DataFrame:
    """Recorded digests (video_id, stage, sha256, fingerprint) against actual ones: rows that differ or are gone."""
    found = checkpoints.join(actual.select("video_id", "stage", F.col("sha256").alias("actual")), ["video_id", "stage"], "left")
    return found.filter(~F.col("sha256").eqNullSafe(F.col("actual"))).select("video_id", "stage", F.when(F.col("actual").isNull(), F.lit("gone")).otherwise(F.lit("changed")).alias("failure"))


def valid(checkpoints: DataFrame, actual: DataFrame, fingerprint: str) -> DataFrame:
    """Checkpoints that a later stage may trust."""
    same = checkpoints.join(audit(checkpoints, actual), ["video_id", "stage"], "left_anti")
    return same.filter(F.col("fingerprint") == fingerprint)


def status(expected: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Videos done and left at each stage."""
    stages = checkpoints.select("stage").distinct()
    done = checkpoints.join(expected, "video_id", "left_semi").groupBy("stage").agg(F.count_distinct("video_id").alias("done"))
    total = expected.agg(F.count_distinct("video_id").alias("videos"))
    return stages.join(done, "stage", "left").crossJoin(F.broadcast(total)).select("stage", F.coalesce("done", F.lit(0)).alias("done"), (F.col("videos") - F.coalesce("done", F.lit(0))).alias("left"))


def todo(expected: DataFrame, checkpoints: DataFrame, actual: DataFrame, fingerprint: str, stage: str) -> DataFrame:
    """Videos that a stage (or its recovery) still has to do."""
    return missing(expected, valid(checkpoints, actual, fingerprint).filter(F.col("stage") == stage))
