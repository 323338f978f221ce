"""Column expressions on frames, shots and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How much a reason counts when extras are admitted; others count OTHER.
PRIORITY = {"quality_rescue": 5.0, "text_change": 4.0, "appearance_change": 3.0, "motion_change": 2.0, "boundary_start": 1.0, "boundary_end": 1.0}
OTHER = 0.25


def double(x: float) -> Column:
    return F.lit(float(x))


def total(values: Column) -> Column:
    return F.aggregate(values, double(0), lambda a, b: a + b)


def shot_length() -> Column:
    return F.col("end_frame") - F.col("start_frame") + 1


def inside_shot(frame: Column) -> Column:
    return frame.between(F.col("start_frame"), F.col("end_frame"))


def clamped(frame: Column) -> Column:
    """The frame of the shot nearest to ``frame``."""
    return F.greatest(F.col("start_frame"), F.least(frame, F.col("end_frame")))


def cluster_id(frame: Column, radius: int) -> Column:
    """Cells of ``radius`` frames, counted from the start of the video."""
    return F.floor(frame / radius).cast("bigint")


def index_id(video_id: Column, n: Column) -> Column:
    """The id of a row of the index: the video and the rank as text."""
    return F.struct(video_id.alias("video_id"), n.cast("string").alias("n"))


#: The fields of a candidate's record.
METRICS = "struct<pixel_sha256:string,dhash:bigint,luma_mean:double,luma_std:double,black_ratio:double,sharpness:double,entropy:double,text_proxy:double,quality_score:double,hard_invalid:boolean>"
RECORD = f"struct<video_id:string,frame_idx:bigint,shot_id:bigint,reasons:array<string>,locator_keep:boolean,hard_keep:boolean,cluster_id:bigint,metrics:{METRICS},selected:boolean,rejected_reason:string>"


def to_record(candidate: Column) -> Column:
    """A candidate (a struct as ``RECORD``) as one JSON object with all its fields, reasons sorted."""
    return F.to_json(candidate.withField("reasons", F.array_sort(candidate["reasons"])), {"ignoreNullFields": "false"})


def from_record(record: Column) -> Column:
    return F.from_json(record, RECORD)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def normalized(a: Column) -> Column:
    """Unit vector; a zero vector is an error."""
    size = norm(a)
    return F.when(size > 1e-12, F.transform(a, lambda x: x.cast("double") / size)).otherwise(F.raise_error(F.lit("zero embedding row")))


def search_view(a: Column, dim: int) -> Column:
    """The first ``dim`` dimensions as a unit vector."""
    return normalized(F.slice(a, 1, dim))


def reason_priority(reasons: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])
    return total(F.transform(reasons, lambda r: F.coalesce(F.try_element_at(known, r), double(OTHER))))


def utility(hard_keep: Column, quality: Column, reasons: Column) -> Column:
    """What a row is worth to a selection; ties go to the earlier frame."""
    return F.when(hard_keep, double(1)).otherwise(double(0)) + F.coalesce(quality, double(0)) + F.least(double(0.3), double(0.05) * F.size(reasons))


def gib(rows: Column, bytes_per_row: int) -> Column:
    return rows * double(bytes_per_row) / double(2**30)


def differences(grid: Column, size: int, lower: bool = False) -> tuple[Column, Column]:
    """Horizontal and vertical differences of a row-major ``size`` x ``size`` grid (or of its lower half)."""
    first = size // 2 if lower else 0
    across = [r * size + c for r in range(first, size) for c in range(size - 1)]
    down = [r * size + c for r in range(first, size - 1) for c in range(size)]
    pick = lambda at, step: F.transform(F.array(*map(F.lit, at)), lambda i: F.get(grid, i + step) - F.get(grid, i))
    return pick(across, 1), pick(down, size)


def mean(values: Column) -> Column:
    return total(values) / F.size(values)


def variance(values: Column) -> Column:
    m = mean(values)
    return mean(F.transform(values, lambda x: (x - m) * (x - m)))


def quality_score(sharpness: Column, entropy: Column, luma_mean: Column, luma_std: Column, invalid: Column) -> Column:
    one = double(1)
    exposure = F.greatest(double(0), one - F.abs(luma_mean - 127.5) / 127.5)
    score = double(0.4) * F.least(one, sharpness / 0.02) + double(0.25) * F.least(one, entropy) + double(0.2) * exposure + double(0.15) * F.least(one, luma_std / 64.0)
    return F.when(invalid, double(0)).otherwise(score)
