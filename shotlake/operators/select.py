"""Selecting the frames of a video: mandatory ones, repaired gaps, quotas per source."""

from __future__ import annotations

import math
from bisect import insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.scalars import utility

FRAME = ["video_id", "shot_id", "frame_idx"]
VIEWS = "video_id string, shot_id bigint, frame_idx bigint, discovery boolean, localization boolean, source string"


def best_of_shots(rows: DataFrame) -> DataFrame:
    """The most useful eligible row of each shot (ties: the earliest)."""
    worth = utility(F.col("hard_keep"), F.col("quality_score"), F.col("reasons"))
    best = F.max(F.struct(worth.alias("utility"), (-F.col("frame_idx")).alias("back")))
    return rows.filter("rejected is null").groupBy("video_id", "shot_id").agg(best.alias("b")).select("video_id", "shot_id", (-F.col("b.back")).alias("frame_idx"), F.col("b.utility").alias("utility"))


def repaired(start: int, end: int, taken: list[int], eligible: dict[int, float], widest: int) -> list[int]:
    """Frames to add so that gaps shrink to ``widest``: always in the widest gap (the first of equals), the eligible
    frame nearest its middle, then the more useful, then the earlier; a gap without one ends the repair."""
    anchors, added = [start, *sorted(taken), end], []
    free = set(eligible) - set(taken)
    while True:
        gap, at = max((b - a, -i) for i, (a, b) in enumerate(zip(anchors, anchors[1:])))
        if gap <= widest:
            return added
        low, high = anchors[-at], anchors[-at + 1]
        inside = [f for f in free if low < f < high]
        if not inside:
            return added
        best = min(inside, key=lambda f: (abs(f - (low + high) / 2), -eligible[f], f))
        free.discard(best)
        added.append(best)
        insort(anchors, best)


def quota_filled(free: dict[int, tuple[float, list[str]]], number: int) -> list[int]:
    """``number`` frames, one at a time from each source in alphabetical order, the most useful of a source first."""
    order = sorted(free, key=lambda f: (-free[f][0], f))
    queues = [iter([f for f in order if source in free[f][1]]) for source in sorted({r for _, rs in free.values() for r in rs})]
    taken: dict[int, None] = {}
    while queues and len(taken) < number:
        left = []
        for queue in queues:
            frame = next((f for f in queue if f not in taken), None)
            if frame is not None and len(taken) < number:
                taken[frame] = None
                left.append(queue)
        queues = left
    for frame in order:  # rows without a reason
        if len(taken) >= number:
            break
        taken.setdefault(frame)
    return list(taken)


def views_of(video: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """Views of one video; ``video`` has a row per candidate with its shot's edges, frame_count, utility and eligible."""
    source: dict[tuple[int, int], str] = {}
    for row in video.itertuples():
        if row.locator and row.rejected != "decode_missing":
            source[row.shot_id, row.frame_idx] = "locator"
        elif row.eligible and row.hard_keep:
            source[row.shot_id, row.frame_idx] = "rescue"
    free: dict[int, tuple[float, list[str]]] = {}
    shot_of: dict[int, int] = {}
    taken_of: dict[int, list[int]] = {}
    for s, f in source:
        taken_of.setdefault(s, []).append(f)
    for shot, rows in video.groupby("shot_id"):
        eligible = {int(r.frame_idx): float(r.utility) for r in rows.itertuples() if r.eligible}
        if not eligible:
            continue
        best = min(eligible, key=lambda f: (-eligible[f], f))
        taken = taken_of.get(shot, [])
        if (shot, best) not in source:
            source[shot, best] = "best"
            taken.append(best)
        for f in repaired(int(rows.start_frame.iloc[0]), int(rows.end_frame.iloc[0]), taken, eligible, settings.discovery_max_gap):
            source[shot, f] = "gap"
        for r in rows.itertuples():
            if r.eligible and (shot, r.frame_idx) not in source:
                free[int(r.frame_idx)] = (float(r.utility), list(r.reasons))
                shot_of[int(r.frame_idx)] = shot
    wanted = int(math.ceil(int(video.frame_count.iloc[0]) / settings.discovery_max_gap) * settings.discovery_budget_multiplier)
    for f in quota_filled(free, min(len(free), max(0, wanted - len(source)))):
        source[shot_of[f], f] = "quota"
    keys = list(zip(video.shot_id, video.frame_idx))
    return pd.DataFrame({
        "video_id": video.video_id, "shot_id": video.shot_id, "frame_idx": video.frame_idx, "discovery": [k in source for k in keys],
        "localization": video.locator & (video.rejected != "decode_missing"), "source": [source.get(k) for k in keys],
    })


def select_views(rows: DataFrame, shots: DataFrame, videos: DataFrame, duplicates: DataFrame, settings: Settings) -> DataFrame:
    """Both views of all videos: one task holds the candidates (not the vectors) of one video at a time."""
    eligible = F.col("rejected").isNull() & F.col("_twin").isNull()
    worth = utility(F.col("hard_keep"), F.col("quality_score"), F.col("reasons"))
    full = rows.join(duplicates.withColumn("_twin", F.lit(True)), FRAME, "left").join(shots.select("video_id", "shot_id", "start_frame", "end_frame"), ["video_id", "shot_id"]).join(videos.select("video_id", "frame_count"), "video_id")
    full = full.select(*FRAME, "reasons", "locator", "hard_keep", "rejected", "start_frame", "end_frame", "frame_count", worth.alias("utility"), eligible.alias("eligible"))
    return full.groupBy("video_id").applyInPandas(lambda video: views_of(video, settings), VIEWS)
