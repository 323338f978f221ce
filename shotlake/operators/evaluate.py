"""Gates over a run: checks as rows, passed if there are none."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.scalars import gib, inside_shot
from ..sources.boundaries import in_zone
from .seeds import max_gap, window_coverage


def rejection_counts(rows: DataFrame) -> DataFrame:
    return rows.filter("rejected is not null").groupBy("rejected").agg(F.count("*").alias("n"))


def candidate_failures(rows: DataFrame, shots: DataFrame, zones: DataFrame, planned: DataFrame, settings: Settings) -> DataFrame:
    """video_id, failure, n: how often each check of a candidate run fails in each video."""
    n = F.count("*").alias("n")
    held = rows.join(shots.select("video_id", "shot_id", "start_frame", "end_frame"), ["video_id", "shot_id"], "left")
    usable = rows.filter("locator and rejected is distinct from 'decode_missing'")
    gaps = max_gap(shots, usable)
    counts = planned.join(rows.groupBy("video_id").agg(F.count("*").alias("rows")), "video_id", "left").filter(F.coalesce("rows", F.lit(0)) != F.col("target_rows"))
    covered = window_coverage(shots, usable, (settings.answer_window_frames,))
    checks = {
        "duplicate frame": rows.groupBy("video_id", "frame_idx").agg(F.count("*").alias("c")).filter("c > 1"),
        "outside its shot": held.filter(F.col("start_frame").isNull() | ~inside_shot(F.col("frame_idx"))),
        "inside a zone": in_zone(rows.select("video_id", "frame_idx"), zones),
        "shot without locator": shots.join(usable, ["video_id", "shot_id"], "left_anti"),
        "shot without eligible frame": shots.join(rows.filter("rejected is null"), ["video_id", "shot_id"], "left_anti"),
        "locator gap over stride": gaps.filter(F.col("max_gap") > settings.sample_stride),
        "answer window not covered": covered.filter(F.col("coverage") < 1 - 1e-12),
        "rows differ from the plan": counts,
        "decode missing": rows.filter("rejected = 'decode_missing'"),
    }
    out = None
    for name, bad in checks.items():
        found = bad.groupBy("video_id").agg(n).select("video_id", F.lit(name).alias("failure"), "n")
        out = found if out is None else out.unionByName(found)
    return out


def first_of(failures: DataFrame, number: int = 5) -> DataFrame:
    """Of each failure the first ``number`` videos and how many there are."""
    place = F.row_number().over(Window.partitionBy("failure").orderBy("video_id"))
    rows = failures.select("failure", "video_id").distinct().withColumn("place", place)
    return rows.groupBy("failure").agg(F.array_sort(F.collect_list(F.when(F.col("place") <= number, F.col("video_id")))).alias("videos"), F.count("*").alias("n"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def set_differences(have: DataFrame, want: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of only one side, with the side; none if both are the same set."""
    missing = want.select(*keys).distinct().join(have, keys, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(have.select(*keys).distinct().join(want, keys, "left_anti").withColumn("side", F.lit("unexpected")))


def throughput(checkpoints: DataFrame) -> DataFrame:
    """Rows a second (rows, seconds) of each video, and over all of them under a null video_id."""
    rate = F.coalesce(F.try_divide(F.sum("rows").cast("double"), F.sum("seconds")), F.lit(0.0))
    return checkpoints.rollup("video_id").agg(F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"), rate.alias("rate"))


def sampling_report(seed_rows: DataFrame, targets: DataFrame, settings: Settings) -> DataFrame:
    """One row: what a run would decode and store."""
    per_shot = seed_rows.groupBy("video_id", "shot_id").agg(F.count("*").alias("rows"), F.count_if("locator").alias("locators"))
    s = per_shot.agg(F.sum("rows").alias("seed_rows"), F.sum("locators").alias("locator_rows"), F.sum(F.ceil(F.col("locators") * F.lit(settings.max_rescue_fraction))).alias("rescue_bound"))
    s = s.crossJoin(F.broadcast(targets.agg(F.count("*").alias("decode_rows"))))
    return s.withColumn("row_bound", F.col("seed_rows") + F.col("rescue_bound")).withColumn("gib_bound", gib(F.col("row_bound"), settings.vector_bytes))


def require_passing(path: str, settings: Settings, videos: int) -> dict:
    """The report at ``path`` if it says that a full run of these settings passed."""
    report = json.loads(Path(path).read_text())
    wanted = {"status": "pass", "scope": "full", "expected_videos": videos, "evaluated_videos": videos, "config_fingerprint": settings.fingerprint, "encoder_fingerprint": settings.encoder_fingerprint}
    wrong = {k: report.get(k) for k, v in wanted.items() if report.get(k) != v}
    if wrong or report.get("rows") != settings.target_embedding_rows:
        raise RuntimeError(f"the gate rejects this run: {wrong or report.get('rows')}")
    return report
