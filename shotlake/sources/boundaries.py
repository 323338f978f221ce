"""Videos and shots: reading, checking, gaps between shots, listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import inside_shot, shot_length

SCHEMA = (
    "video struct<video_id:string,path:string,width:int,height:int,fps:double,frame_count:bigint,duration_seconds:double>,"
    "shots array<struct<shot_id:bigint,start_frame:bigint,end_frame:bigint,boundary_score:double>>"
)


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Videos and shots of a folder of boundary files, one JSON object each; ``pos`` is a shot's place in its file."""
    raw = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    videos = raw.select("video.*").fillna({"path": "", "duration_seconds": 0.0})
    shots = raw.select(F.col("video.video_id").alias("video_id"), F.posexplode("shots").alias("pos", "s")).select("video_id", "pos", "s.*")
    return videos, shots


def zones(shots: DataFrame, videos: DataFrame) -> DataFrame:
    """Frames between shots (unassigned_gap) and behind the last one (unassigned_tail)."""
    before = F.lag("end_frame", 1, -1).over(Window.partitionBy("video_id").orderBy("start_frame"))
    gaps = shots.withColumn("before", before).filter("start_frame > before + 1")
    gaps = gaps.select("video_id", (F.col("before") + 1).alias("start_frame"), (F.col("start_frame") - 1).alias("end_frame"), F.lit("unassigned_gap").alias("kind"))
    ends = shots.groupBy("video_id").agg(F.max("end_frame").alias("last")).join(videos.select("video_id", "frame_count"), "video_id")
    tails = ends.filter("last < frame_count - 1").select("video_id", (F.col("last") + 1).alias("start_frame"), (F.col("frame_count") - 1).alias("end_frame"), F.lit("unassigned_tail").alias("kind"))
    return gaps.unionByName(tails)


def violations(shots: DataFrame, videos: DataFrame, order: str = "pos") -> DataFrame:
    """One row per broken rule: video_id, shot_id (null for a video's), violation."""
    places = Window.partitionBy("video_id").orderBy(order)
    known = shots.join(videos.select("video_id", "frame_count"), "video_id")
    known = known.withColumn("before", F.lag("end_frame", 1, -1).over(places)).withColumn("twins", F.count("*").over(Window.partitionBy("video_id", "shot_id")))
    broken = F.array(
        F.when((F.col("start_frame") < 0) | (F.col("end_frame") >= F.col("frame_count")) | (shot_length() <= 0), F.lit("bounds")),
        F.when(F.col("start_frame") <= F.col("before"), F.lit("overlap")),
        F.when(F.col("twins") > 1, F.lit("duplicate")),
    )
    of_shots = known.select("video_id", "shot_id", F.explode(F.array_compact(broken)).alias("violation"))
    invalid = videos.filter("frame_count <= 0 or fps <= 0").select("video_id", F.lit("metadata").alias("violation"))
    empty = videos.join(shots, "video_id", "left_anti").select("video_id", F.lit("no shots").alias("violation"))
    return of_shots.unionByName(invalid.unionByName(empty), allowMissingColumns=True)


def shot_of(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """``frames`` (video_id, frame_idx) with shot_id, null between shots.

    Shots do not overlap, so the last one that starts at or before a frame is the
    only candidate: one sort per video instead of a range join.
    """
    marks = shots.select("video_id", F.col("start_frame").alias("frame_idx"), F.lit(0).alias("kind"), "shot_id", "end_frame")
    rows = frames.withColumns({"kind": F.lit(1), "shot_id": F.lit(None).cast("bigint"), "end_frame": F.lit(None).cast("bigint")})
    order = Window.partitionBy("video_id").orderBy("frame_idx", "kind").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct("shot_id", "end_frame")), True).over(order)
    found = rows.unionByName(marks, allowMissingColumns=True).withColumn("last", last).filter("kind = 1")
    held = F.when(F.col("frame_idx") <= F.col("last.end_frame"), F.col("last.shot_id"))
    return found.select(*frames.columns, held.alias("shot_id"))


def in_zone(frames: DataFrame, zone: DataFrame) -> DataFrame:
    """The frames that lie in a zone."""
    z = zone.select(F.col("video_id").alias("_v"), "start_frame", "end_frame")
    return frames.join(z, (frames.video_id == F.col("_v")) & inside_shot(frames.frame_idx), "left_semi")


def chosen(videos: DataFrame, groups: list[str], start: int = 0, end: int = 0, pattern: str = r"_V(\d+)$") -> DataFrame:
    """Videos of the groups (prefixes of video_id), and of the ordinals from start to end unless both are 0."""
    if not groups or not all(groups):
        raise ValueError("groups have to be named")
    any_of: Column = F.lit(False)
    for group in groups:
        any_of = any_of | F.startswith(F.col("video_id"), F.lit(group))
    out = videos.filter(any_of)
    if start or end:
        if not 0 < start <= end:
            raise ValueError("start and end have to be 1 or more, in order")
        out = out.filter(F.regexp_extract("video_id", pattern, 1).cast("int").between(start, end))
    return out


def video_ids(spark: SparkSession, group: str, start: int, end: int) -> DataFrame:
    return spark.range(start, end + 1).select(F.format_string("%s_V%03d", F.lit(group), "id").alias("video_id"))


def probe_mismatches(expected: DataFrame, observed: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Videos whose observed metadata differ: video_id and all mismatches."""
    o = observed.select("video_id", *[F.col(c).alias(f"o_{c}") for c in ("width", "height", "frame_count", "fps")])
    differs = [F.when(~F.col(c).eqNullSafe(F.col(f"o_{c}")), F.lit(c)) for c in ("width", "height", "frame_count")]
    differs.append(F.when(F.col("o_fps").isNull() | (F.abs(F.col("fps") - F.col("o_fps")) > tolerance), F.lit("fps")))
    found = expected.join(o, "video_id", "left").withColumn("mismatches", F.array_compact(F.array(*differs)))
    return found.filter(F.size("mismatches") > 0).select("video_id", "mismatches")
