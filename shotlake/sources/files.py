"""Files beside the tables: atomic writes, digests, JSON lines, arrays, archives, video."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import subprocess
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np


def sha256_file(path: str | Path) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def write_bytes(path: str | Path, data: bytes) -> None:
    """All or nothing: readers see the old file or the whole new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile(dir=path.parent, prefix=f".{path.name}.", delete=False) as file:
        try:
            file.write(data)
            file.flush()
            os.fsync(file.fileno())
            os.replace(file.name, path)
        except BaseException:
            Path(file.name).unlink(missing_ok=True)
            raise


def write_json(path: str | Path, value) -> None:
    write_bytes(path, (json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode())


def write_jsonl(path: str | Path, rows: Iterable[dict]) -> None:
    write_bytes(path, "".join(json.dumps(r, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n" for r in rows).encode())


def read_jsonl(path: str | Path) -> list[dict]:
    return [json.loads(line) for line in Path(path).read_text().splitlines() if line.strip()]


def write_csv(path: str | Path, rows: Iterable[dict], columns: list[str]) -> None:
    text = io.StringIO(newline="")
    out = csv.DictWriter(text, columns, extrasaction="ignore")
    out.writeheader()
    out.writerows(rows)
    write_bytes(path, text.getvalue().encode())


def write_npy(path: str | Path, values: np.ndarray) -> None:
    data = io.BytesIO()
    np.save(data, values, allow_pickle=False)
    write_bytes(path, data.getvalue())


def read_npy(path: str | Path, mapped: bool = True) -> np.ndarray:
    """An array file, mapped into memory or read whole; pickled objects are refused."""
    return np.load(path, mmap_mode="r" if mapped else None, allow_pickle=False)


def npy_rows(spark, path: str):
    """The rows of two-dimensional array files (path, row, embedding), a file in each task; pickled objects are refused."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                values = np.load(io.BytesIO(content.as_py()), allow_pickle=False)
                for a in range(0, len(values), 1024):
                    part = np.asarray(values[a : a + 1024], np.float32)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), part.shape[1]).cast(pa.list_(pa.float32()))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(np.arange(a, a + len(part))), lists], ["path", "row", "embedding"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row bigint, embedding array<float>")


def write_report(path: str | Path, report: dict) -> None:
    """A gate's report, all or nothing."""
    write_json(path, report)


def sync(source: str | Path, target: str | Path, pattern: str = "*.json") -> list[str]:
    """Copy the files of a folder over those of another; gives their names."""
    names = sorted(p.name for p in Path(source).glob(pattern))
    for name in names:
        write_bytes(Path(target) / name, (Path(source) / name).read_bytes())
    return names


def verify_pointer(folder: str | Path) -> dict:
    """The published manifest; one that isn't what the pointer says is an error."""
    pointer = json.loads((Path(folder) / "CURRENT.json").read_text())
    target = Path(folder) / pointer["manifest"]
    if sha256_file(target) != pointer["sha256"]:
        raise RuntimeError(f"{target} is not the published manifest")
    return json.loads(target.read_text())


def export_index(index, folder: str | Path) -> None:
    """A flat index (row_id, video_id, n, frame_idx, embedding) as arrays for other tools, row by row from the driver's
    iterator; ids longer than 24 characters are refused, as the array type would cut them."""
    emb, ids, frames, spans = [], [], [], {}
    for row in index.orderBy("row_id").toLocalIterator():
        if len(row.video_id) > 24:
            raise ValueError(f"id too long for the index: {row.video_id}")
        first = spans.setdefault(row.video_id, [row.row_id, row.row_id])
        first[1] = row.row_id + 1
        emb.append(np.asarray(row.embedding, np.float16))
        ids.append((row.video_id, str(row.n)))
        frames.append(row.frame_idx)
    folder = Path(folder)
    write_npy(folder / "emb.npy", np.stack(emb) if emb else np.zeros((0, 0), np.float16))
    write_npy(folder / "ids.npy", np.array(ids, "<U24").reshape(-1, 2))
    write_npy(folder / "frame_idx.npy", np.array(frames, np.int32))
    write_json(folder / "ranges.json", spans)


def publish(folder: str | Path, manifest: dict) -> None:
    """The manifest, and only then the pointer that names it with its digest."""
    target = Path(folder) / "manifest.json"
    write_json(target, manifest)
    write_json(Path(folder) / "CURRENT.json", {"manifest": target.name, "sha256": sha256_file(target)})


def unpack(archive: str | Path, folder: str | Path, group: str, number: int) -> dict[str, int]:
    """The archive's videos, which have to be ``number`` different ones of the group; present ones of the same size stay."""
    folder, done = Path(folder), {"extracted": 0, "skipped": 0}
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive) as file:
        members = sorted((m for m in file.infolist() if m.filename.lower().endswith(".mp4")), key=lambda m: m.filename)
        names = [Path(m.filename).name for m in members]
        if len(members) != number or len(set(names)) != number:
            raise ValueError(f"{len(set(names))} videos in {len(members)} members, expected {number}")
        for member, name in zip(members, names):
            if ".." in Path(member.filename).parts or member.filename.startswith("/") or not name.startswith(f"{group}_V"):
                raise ValueError(f"unexpected member {member.filename}")
            target = folder / name
            if target.exists() and target.stat().st_size == member.file_size:
                done["skipped"] += 1
                continue
            part = target.with_suffix(".part")
            with file.open(member) as source, part.open("wb") as out:
                while data := source.read(1 << 20):
                    out.write(data)
            os.replace(part, target)
            done["extracted"] += 1
    return done


def probe(path: str | Path) -> dict:
    """Width, height, fps and frames of a video file, by ffprobe."""
    entries = "stream=width,height,avg_frame_rate,nb_read_frames,nb_frames,duration"
    got = subprocess.run(["ffprobe", "-v", "error", "-select_streams", "v:0", "-count_frames", "-show_entries", entries, "-of", "json", str(path)], check=True, capture_output=True)
    return parse_probe(json.loads(got.stdout)["streams"][0], Path(path))


def parse_probe(stream: dict, path: Path) -> dict:
    over, under = (stream["avg_frame_rate"].split("/") + ["1"])[:2]
    frames = next((int(stream[k]) for k in ("nb_read_frames", "nb_frames") if str(stream.get(k, "")).isdigit()), 0)
    return {"video_id": path.stem, "path": str(path), "width": stream["width"], "height": stream["height"], "fps": float(over) / float(under) if float(under) else 0.0, "frame_count": frames, "duration_seconds": float(stream.get("duration") or 0)}


def wanted_frames(decoded: Iterable, targets: Iterable[int]) -> Iterator[tuple[int, object]]:
    """Merge join of a video's frames, in order, with the targets; stops at the last one, and never seeks."""
    wanted = sorted(set(targets))
    if wanted and wanted[0] < 0:
        raise ValueError("negative frame")
    at = 0
    for i, frame in enumerate(decoded):
        if at == len(wanted):
            return
        if i == wanted[at]:
            yield i, frame
            at += 1


def decode(path: str | Path, targets: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Target frames of a video file as 8-bit RGB; those past its end are left out.  Needs PyAV."""
    import av

    with av.open(str(path)) as container:
        stream = container.streams.video[0]
        stream.thread_type = "AUTO"
        for i, frame in wanted_frames(container.decode(stream), targets):
            yield i, frame.to_ndarray(format="rgb24")


def decoded_metrics(targets, settings, decoder=decode):
    """Metrics of the target frames (video_id, path, frames array), one task per video; pixels never leave it."""
    import pandas as pd

    from ..functions.pixels import METRICS, metrics

    names = [x.split()[0] for x in METRICS.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.itertuples():
                rows = [{"video_id": row.video_id, "frame_idx": i} | metrics(rgb, settings) for i, rgb in decoder(row.path, row.frames)]
                if rows:
                    yield pd.DataFrame(rows)[["video_id", "frame_idx", *names]]

    return targets.select("video_id", "path", "frames").mapInPandas(run, f"video_id string, frame_idx bigint, {METRICS}")


def write_images(rows, folder: str, encoder):
    """Lossless images of frames (video_id, n, height, width, rgb, pixel_sha256), read back and compared with their digest.

    ``encoder`` has ``encode(rgb) -> bytes`` and ``decode(bytes) -> rgb``; the folder has to be one that all executors share.
    """
    import pandas as pd

    def run(batches):
        for batch in batches:
            done = []
            for row in batch.itertuples():
                rgb = np.frombuffer(row.rgb, np.uint8).reshape(row.height, row.width, 3)
                target = Path(folder) / row.video_id / f"{row.n}.webp"
                write_bytes(target, encoder.encode(rgb))
                if hashlib.sha256(np.ascontiguousarray(encoder.decode(target.read_bytes())).tobytes()).hexdigest() != row.pixel_sha256:
                    raise RuntimeError(f"{target} does not give its frame back")
                done.append((row.video_id, row.n, str(target), sha256_file(target)))
            yield pd.DataFrame(done, columns=["video_id", "n", "path", "sha256"])

    return rows.mapInPandas(run, "video_id string, n bigint, path string, sha256 string")
