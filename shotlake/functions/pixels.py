"""Metrics of decoded RGB frames in NumPy, for Arrow functions.

The resize is an antialiased triangle filter (support grows with the reduction);
it is meant to follow the common image libraries' bilinear reduction and has not
been compared with one here.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..config import Settings

METRICS = "pixel_sha256 string, dhash bigint, luma_mean double, luma_std double, black_ratio double, sharpness double, entropy double, text_proxy double, quality_score double, hard_invalid boolean"


@functools.cache
def _weights(source: int, target: int) -> np.ndarray:
    scale = source / target
    reach = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    w = np.clip(1 - np.abs(np.arange(source) + 0.5 - centre[:, None]) / reach, 0, None)
    return w / w.sum(axis=1, keepdims=True)


def resized(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bytes in, bytes out, rounded like 8-bit images."""
    across = np.floor(gray @ _weights(gray.shape[1], width).T + 0.5)
    return np.clip(np.floor(_weights(gray.shape[0], height) @ across + 0.5), 0, 255)


def luma(rgb: np.ndarray) -> np.ndarray:
    if rgb.ndim != 3 or rgb.shape[2] != 3 or rgb.dtype != np.uint8:
        raise ValueError("a frame has to be 8-bit RGB")
    r, g, b = (rgb[..., i].astype(np.int64) for i in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(float)


def dhash(gray: np.ndarray) -> int:
    """Whether each of 8 x 8 places is darker than its right neighbour; signed 64 bits."""
    small = resized(np.floor(np.clip(gray, 0, 255)), 8, 9)
    bits = np.packbits((small[:, 1:] > small[:, :-1]).ravel())
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def metrics(rgb: np.ndarray, settings: Settings) -> dict:
    full = luma(rgb)
    gray = resized(full, settings.thumbnail_size, settings.thumbnail_size)
    across, down = np.diff(gray, axis=1), np.diff(gray, axis=0)
    lower = gray[len(gray) // 2 :]
    share = np.bincount((gray // 8).astype(int).ravel(), minlength=32) / gray.size
    share = share[share > 0]
    out = {
        "pixel_sha256": hashlib.sha256(np.ascontiguousarray(rgb).tobytes()).hexdigest(),
        "dhash": dhash(gray),
        "luma_mean": float(gray.mean()),
        "luma_std": float(gray.std()),
        "black_ratio": float((gray <= settings.black_luma_threshold).mean()),
        "sharpness": float((across.var() + down.var()) / 255**2),
        "entropy": float(-(share * np.log2(share)).sum() / 5),
        "text_proxy": float((np.abs(np.diff(lower, axis=1)).mean() + np.abs(np.diff(lower, axis=0)).mean()) / 510),
    }
    out["hard_invalid"] = out["black_ratio"] >= settings.black_ratio_threshold
    exposure = max(0.0, 1 - abs(out["luma_mean"] - 127.5) / 127.5)
    score = 0.4 * min(1, out["sharpness"] / 0.02) + 0.25 * min(1, out["entropy"]) + 0.2 * exposure + 0.15 * min(1, out["luma_std"] / 64)
    return out | {"quality_score": 0.0 if out["hard_invalid"] else score}


def frame_metrics(frames: DataFrame, settings: Settings) -> DataFrame:
    """``frames`` (video_id, frame_idx, height, width, rgb binary) with metrics in place of the pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                rgb = np.frombuffer(row["rgb"], np.uint8).reshape(row["height"], row["width"], 3)
                rows.append({"video_id": row["video_id"], "frame_idx": row["frame_idx"]} | metrics(rgb, settings))
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    names = [x.split()[0] for x in f"video_id string, frame_idx bigint, {METRICS}".split(", ")]

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.select(names)

    return frames.select("video_id", "frame_idx", "height", "width", "rgb").mapInArrow(ordered, f"video_id string, frame_idx bigint, {METRICS}")


def encode(frames: DataFrame, encoder: Callable[[list[bytes]], np.ndarray], settings: Settings, batch: int = 32) -> DataFrame:
    """Unit vectors of the frames (column rgb), computed in 32 bits and stored in 16, ``batch`` frames at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                v = np.asarray(encoder(part.column("rgb").to_pylist()), np.float32)
                if v.shape != (part.num_rows, settings.embedding_dim):
                    raise ValueError(f"the encoder gave {v.shape}")
                size = np.linalg.norm(v, axis=1, keepdims=True)
                if not np.isfinite(size).all() or (size <= 1e-12).any():
                    raise ValueError("zero or infinite embedding row")
                half = (v / size).astype("<f2")
                columns = [part.column("video_id"), part.column("frame_idx"), pa.array([x.tobytes() for x in half]), pa.array(list(half.astype(np.float32)), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, ["video_id", "frame_idx", "emb_f16", "embedding"])

    return frames.select("video_id", "frame_idx", "rgb").mapInArrow(run, "video_id string, frame_idx bigint, emb_f16 binary, embedding array<float>")
