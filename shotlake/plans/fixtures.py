"""The driver tables as keyframe data: users are videos, events are frames, sessions are shots.

A session that begins with an error leaves that frame unassigned, which makes zones.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once: a checkpoint in the session's shared folder, or in a temporary one in local mode where none is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="shotlake-stages-"))
    return df.checkpoint()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, frame_idx, event_id, value, shot_id, in_zone."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events(spark, sf_dir).withColumns({"before": F.lag("ts").over(order), "frame_idx": (F.row_number().over(order) - 1).cast("bigint")})
    fresh = F.col("before").isNull() | F.expr("ts - before > interval '24' hour")
    rows = rows.withColumn("brk", F.when(fresh, 1).otherwise(0))
    rows = rows.withColumn("shot_id", F.sum("brk").over(Window.partitionBy("user_id").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)))
    name = F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
    return rows.select(name.alias("video_id"), "frame_idx", "event_id", "value", "shot_id", ((F.col("brk") == 1) & (F.col("event_type") == "error")).alias("in_zone"))


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = frames(spark, sf_dir).groupBy("video_id").agg((F.max("frame_idx") + 1).alias("frame_count"))
    return sizes.select("video_id", F.lit(1280).alias("width"), F.lit(720).alias("height"), F.lit(25.0).alias("fps"), "frame_count")


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).filter("not in_zone").groupBy("video_id", "shot_id").agg(F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up metrics; frames of every 97th event were not decoded."""
    rows = frames(spark, sf_dir).filter("not in_zone and event_id % 97 <> 0")
    return rows.select(
        "video_id", "shot_id", "frame_idx", (F.col("event_id") % 8).cast("bigint").alias("dhash"), ((F.col("event_id") * 17) % 64).cast("double").alias("luma_std"),
        ((F.col("event_id") % 101).cast("double") / 101).alias("text_proxy"), (F.col("value") < 15).alias("hard_invalid"),
        F.when(F.col("value") < 15, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.col("value") / 500)).alias("quality_score"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in turn; two frames in three have one of the first seven, so that exact duplicates occur."""
    all_of = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = frames(spark, sf_dir).filter("not in_zone and event_id % 97 <> 0").crossJoin(F.broadcast(all_of.agg(F.count("*").alias("number"))))  # one row
    rows = rows.withColumn("vec_id", F.col("event_id") % F.when(F.col("event_id") % 3 == 0, F.col("number")).otherwise(7))
    return rows.join(all_of, "vec_id").select("video_id", "shot_id", "frame_idx", "embedding")


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as an 8 x 8 grid of luma."""
    luma = F.transform("embedding", lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), (x.cast("double") + 0.6) * 200)))
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", luma.alias("grid"))
