from __future__ import annotations

import glob
import json

import duckdb
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from shotlake.config import SMALL, Settings
from shotlake.functions import pixels, scalars
from shotlake.operators import budget, seeds, select, vectors
from shotlake.plans import catalogue, fixtures
from shotlake.plans.run import Run
from shotlake.sources import boundaries, files


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {path.split('/')[-1][:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, tables, name):
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = tables.execute(catalogue.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in found.fetchall()]
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


@pytest.fixture
def two_shots(spark):
    videos = spark.createDataFrame([("L21_V001", 320, 180, 25.0, 42)], "video_id string, width int, height int, fps double, frame_count bigint")
    shots = spark.createDataFrame([("L21_V001", 1, 0, 19), ("L21_V001", 2, 22, 41)], "video_id string, shot_id bigint, start_frame bigint, end_frame bigint")
    return shots, videos


def test_shots_and_gap(spark, two_shots):
    shots, videos = two_shots
    assert [tuple(r) for r in boundaries.zones(shots, videos).collect()] == [("L21_V001", 20, 21, "unassigned_gap")]
    frames = spark.createDataFrame([("L21_V001", 20), ("L21_V001", 22)], "video_id string, frame_idx bigint")
    assert {r.frame_idx: r.shot_id for r in boundaries.shot_of(frames, shots).collect()} == {20: None, 22: 2}


def test_seeds_and_plan(two_shots):
    shots, _ = two_shots
    rows = seeds.seeds(shots, Settings(sample_stride=8, neighbor_radius=3, raw_refine_radius=7))
    assert sorted(r.frame_idx for r in rows.filter("locator").collect()) == [7, 15, 29, 37]
    assert seeds.window_coverage(shots, rows, (8,)).first().coverage == 1
    plan = budget.plan(budget.capacities(seeds.seeds(shots, Settings())), 7).first()
    assert (plan.locator_rows, plan.target_rows) == (4, 7)


def test_search_view(spark):
    rows = spark.createDataFrame([([3.0, 4.0, 12.0],), ([0.0, 2.0, 0.0],)], "e array<float>").select(scalars.search_view(__import__("pyspark").sql.functions.col("e"), 2).alias("u")).collect()
    assert np.allclose([r.u for r in rows], [[0.6, 0.8], [0, 1]], atol=1e-6)


def test_settings():
    assert Settings().fingerprint == Settings().fingerprint != Settings(sample_stride=7, neighbor_radius=4).fingerprint
    with pytest.raises(ValueError):
        Settings(sample_stride=11)


def test_repair_and_quota():
    assert select.repaired(0, 20, [4], {12: 0.5, 9: 0.4, 15: 0.1}, 8) == [12]
    assert select.repaired(0, 40, [], {39: 1.0}, 10) == [39]  # the widest gap has no other frame: the rest stays open
    free = {1: (0.9, ["b"]), 2: (0.8, ["a", "b"]), 3: (0.7, []), 4: (0.6, ["a"])}
    assert select.quota_filled(free, 3) == [2, 1, 4] and select.quota_filled(free, 9) == [2, 1, 4, 3]


def test_views(spark):
    rows = catalogue.QUERIES["q_select_views"](spark, SF).collect()
    assert all(r.discovery for r in rows if r.localization) and all((r.source is not None) == r.discovery for r in rows)


def test_gate_reports_all_checks(spark):
    found = {r.failure for r in catalogue.QUERIES["q_candidate_gate"](spark, SF).collect()}
    assert {"locator gap over stride", "answer window not covered", "decode missing"} <= found


def test_pixels():
    rgb = np.zeros((90, 160, 3), np.uint8)
    rgb[:, 80:] = 200
    m = pixels.metrics(rgb, Settings())
    assert not m["hard_invalid"] and 0.4 < m["black_ratio"] < 0.6 and 0 < m["quality_score"] <= 1
    assert pixels.metrics(np.zeros((8, 8, 3), np.uint8), Settings())["quality_score"] == 0
    assert np.array_equal(pixels.resized(np.full((30, 50), 7.0), 8, 9), np.full((8, 9), 7.0))


def test_files(tmp_path):
    files.write_jsonl(tmp_path / "a.jsonl", [{"b": 1, "a": "é"}])
    assert files.read_jsonl(tmp_path / "a.jsonl") == [{"a": "é", "b": 1}]
    files.write_csv(tmp_path / "a.csv", [{"x": 1, "y": 2}], ["x"])
    assert (tmp_path / "a.csv").read_text().split() == ["x", "1"]
    files.publish(tmp_path, {"rows": 1})
    assert json.loads((tmp_path / "CURRENT.json").read_text())["sha256"] == files.sha256_file(tmp_path / "manifest.json")
    assert list(files.wanted_frames("abcdef", [4, 1, 1, 9])) == [(1, "b"), (4, "e")]


def test_integrity(spark):
    rows = spark.createDataFrame([("v", 1, [1.0, 0.0])], "video_id string, frame_idx bigint, embedding array<float>")
    assert vectors.integrity(rows, rows, Settings(embedding_dim=2, search_dim=2)).first().failures == []
    assert vectors.integrity(rows, rows, SMALL).first().failures == ["wrong_dim"]


def test_vector_match(spark):
    data = catalogue.Data(spark, SF)
    row = catalogue.QUERIES["q_vector_match"](spark, SF).first()
    admitted, stored = [{(r.video_id, r.frame_idx) for r in x.select("video_id", "frame_idx").collect()} for x in (data.admitted, data.vectors)]
    assert row.missing == len(admitted - stored) > 0 and row.unexpected == len(stored - admitted) > 0
    assert row.failures == "missing,unexpected"


def test_run(spark, tmp_path):
    """A run does what is left: after one video's metrics change, only that video, after other settings nothing."""
    from dataclasses import replace

    shots, videos, metrics, encoded = fixtures.shots(spark, SF), fixtures.videos(spark, SF), fixtures.metrics(spark, SF), fixtures.vectors(spark, SF)
    some = [r.video_id for r in videos.orderBy("video_id").limit(3).collect()]
    shots, videos, metrics, encoded = [x.filter(x.video_id.isin(some)) for x in (shots, videos, metrics, encoded)]
    total = seeds.seeds(shots, SMALL).count()
    settings = replace(SMALL, target_embedding_rows=total)
    run = Run(spark, str(tmp_path / "run"), settings, shots, videos)
    index = run.execute(metrics, encoded)
    rows = index.count()
    assert rows and index.agg({"row_id": "max"}).first()[0] == rows - 1
    assert run.left("views").count() == 0 and all(r.left == 0 for r in run.status().collect())
    assert files.verify_pointer(tmp_path / "run")["rows"] == rows
    with pytest.raises(RuntimeError):
        Run(spark, run.root, SMALL, shots, videos).guard()

    planned = budget.plan(budget.capacities(seeds.seeds(shots, settings)), total)
    changed = metrics.withColumn("quality_score", F.when(F.col("video_id") == some[1], F.col("quality_score") / 2).otherwise(F.col("quality_score")))
    assert run.left("candidates", [shots, metrics, planned]).count() == 0
    assert [r.video_id for r in run.left("candidates", [shots, changed, planned]).collect()] == [some[1]]

    def work(todo):
        if todo.filter(F.col("video_id") == some[1]).count():
            raise ValueError("no")
        return rows

    report = run.recover("candidates", work, [shots, changed, planned])
    assert report["status"] == "partial" and list(report["failures"]) == [some[1]] and report["tried"] == 1


def test_arrays_and_records(spark, tmp_path):
    values = np.arange(12, dtype=np.float16).reshape(4, 3)
    files.write_npy(tmp_path / "a.npy", values)
    assert np.array_equal(files.read_npy(tmp_path / "a.npy"), values)
    rows = files.npy_rows(spark, str(tmp_path / "*.npy")).orderBy("row").collect()
    assert [r.embedding for r in rows] == values.tolist()
    np.save(tmp_path / "b.npy", np.array([{}], object), allow_pickle=True)
    with pytest.raises(ValueError):
        files.read_npy(tmp_path / "b.npy", False)
    files.write_report(tmp_path / "in" / "x.json", {"b": 1})
    assert files.sync(tmp_path / "in", tmp_path / "out") == ["x.json"] and json.loads((tmp_path / "out" / "x.json").read_text()) == {"b": 1}
    files.publish(tmp_path, {"rows": 1})
    (tmp_path / "manifest.json").write_text("{}")
    with pytest.raises(RuntimeError):
        files.verify_pointer(tmp_path)
    assert Settings.of({"sample_stride": 8, "neighbor_radius": 3}).sample_stride == 8
    with pytest.raises(TypeError):
        Settings.of({"stride": 8})
    assert Settings().fingerprint != Settings(raw_refine_radius=10).fingerprint


def test_boundary_files(spark, tmp_path):
    for k, shots_of in enumerate(([(1, 0, 19), (2, 22, 41)], [(1, 0, 9), (1, 5, 60)])):
        video = {"video_id": f"L21_V00{k + 1}", "width": 320, "height": 180, "fps": 25, "frame_count": 42}
        (tmp_path / f"{k}.json").write_text(json.dumps({"video": video, "shots": [dict(zip(("shot_id", "start_frame", "end_frame"), x)) for x in shots_of]}))
    videos, shots = boundaries.read(spark, str(tmp_path))
    assert videos.count() == 2 and shots.count() == 4
    found = sorted((r.video_id, r.shot_id, r.violation) for r in boundaries.violations(shots, videos).collect())
    assert found == [("L21_V002", 1, "bounds"), ("L21_V002", 1, "duplicate"), ("L21_V002", 1, "duplicate"), ("L21_V002", 1, "overlap")]
    with pytest.raises(ValueError):
        boundaries.chosen(videos, [])
    stream = {"width": 1, "height": 2, "avg_frame_rate": "30000/1001", "nb_read_frames": "9", "duration": "0.3"}
    assert files.parse_probe(stream, tmp_path / "L21_V001.mp4")["frame_count"] == 9


def test_decoded_metrics_and_vectors(spark):
    """A fake decoder and encoder in place of the video library and the model."""
    targets = spark.createDataFrame([("a", "x", [0, 2]), ("b", "y", [5])], "video_id string, path string, frames array<bigint>")

    def decoder(path, frames):
        return files.wanted_frames((np.full((8, 8, 3), 60 * i, np.uint8) for i in range(4)), frames)

    rows = sorted((r.video_id, r.frame_idx, r.luma_mean) for r in files.decoded_metrics(targets, Settings(), decoder).collect())
    assert rows == [("a", 0, 0.0), ("a", 2, 120.0)]  # frame 5 is past the end
    settings = Settings(embedding_dim=2, search_dim=2)
    frames = spark.createDataFrame([("a", i, bytes([i, 4])) for i in range(1, 70)], "video_id string, frame_idx bigint, rgb binary")
    got = pixels.encode(frames, lambda some: np.array([[x[0], x[1]] for x in some], np.float32), settings, 32).collect()
    assert len(got) == 69 and all(abs(np.hypot(*r.embedding) - 1) < 2e-3 and len(r.emb_f16) == 4 for r in got)
