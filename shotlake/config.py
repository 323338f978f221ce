"""Settings that decide what the engine produces, and their fingerprints."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass


def _digest(values: dict) -> str:
    return hashlib.sha256(json.dumps(values, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class Settings:
    # Names and defaults of the settings; equal values give equal fingerprints.
    schema_version: str = "keyframes/v1"
    sample_stride: int = 10
    answer_window_frames: int = 10
    neighbor_radius: int = 4
    cluster_radius: int = 8
    discovery_max_gap: int = 10
    discovery_budget_multiplier: float = 1.15
    raw_refine_radius: int = 9
    thumbnail_size: int = 64
    black_luma_threshold: float = 8.0
    black_ratio_threshold: float = 0.985
    hard_blur_threshold: float = 0.15
    rescue_min_gain: float = 0.08
    max_rescue_fraction: float = 0.15
    appearance_mad_scale: float = 3.0
    motion_mad_scale: float = 3.0
    text_mad_scale: float = 3.0
    dhash_duplicate_distance: int = 2
    semantic_duplicate_cosine: float = 0.985
    semantic_local_window: int = 24
    min_frames_per_shot: int = 1
    target_embedding_rows: int = 627_000
    max_candidate_rows: int = 627_000
    max_vector_gib: float = 1.25
    embedding_dim: int = 1024
    search_dim: int = 512
    embedding_dtype: str = "float16"
    encoder_model: str = "jinaai/jina-clip-v2"
    encoder_revision: str = "e10d47f5691d0454a0fb5d13f46f2199b74cb436"
    encoder_code_revision: str = "39e6a55ae971b59bea6e44675d237c99762e7ee2"
    image_size: int = 512
    image_resize: str = "shortest"
    image_interpolation: str = "bicubic"
    normalize_vectors: bool = True

    def __post_init__(self) -> None:
        rules = {
            "sample_stride must be positive": self.sample_stride >= 1,
            "sample_stride must fit the answer window": self.sample_stride <= self.answer_window_frames,
            "neighbor_radius must be in [0, sample_stride)": 0 <= self.neighbor_radius < self.sample_stride,
            "discovery_max_gap must hold a stride": self.discovery_max_gap >= self.sample_stride,
            "discovery_budget_multiplier must be 1 or more": self.discovery_budget_multiplier >= 1,
            "max_rescue_fraction must be in [0, 1]": 0 <= self.max_rescue_fraction <= 1,
            "search_dim must be in (0, embedding_dim]": 0 < self.search_dim <= self.embedding_dim,
            "target_embedding_rows must fit max_candidate_rows": self.target_embedding_rows <= self.max_candidate_rows,
            "raw_refine_radius must cover a stride": self.raw_refine_radius >= self.sample_stride - 1,
            "semantic_duplicate_cosine must be in (0, 1]": 0 < self.semantic_duplicate_cosine <= 1,
        }
        broken = [rule for rule, holds in rules.items() if not holds]
        if broken:
            raise ValueError("; ".join(broken))

    @classmethod
    def of(cls, values: dict) -> Settings:
        """Settings from a mapping; an unknown name is a TypeError."""
        return cls(**values)

    @property
    def fingerprint(self) -> str:
        return _digest(asdict(self))

    @property
    def encoder_fingerprint(self) -> str:
        # The names under which the encoder's settings are hashed.
        renamed = {
            "model": "encoder_model", "revision": "encoder_revision", "code_revision": "encoder_code_revision", "dim": "embedding_dim", "dtype": "embedding_dtype",
            "image_size": "image_size", "resize": "image_resize", "interpolation": "image_interpolation", "normalized": "normalize_vectors",
        }
        return _digest({k: getattr(self, v) for k, v in renamed.items()})

    @property
    def vector_bytes(self) -> int:
        return self.embedding_dim * {"float16": 2, "float32": 4}[self.embedding_dtype]


#: Settings for the driver tables: short shots and 64 dimensions.
SMALL = Settings(sample_stride=4, answer_window_frames=4, neighbor_radius=3, discovery_max_gap=4, raw_refine_radius=3, embedding_dim=64, search_dim=32)
