"""A resumable run over videos: plan, candidates, vectors, selection, index.

Each stage writes its rows per video under ``root/stage`` and a checkpoint row per
video with the digests of its rows and of what they were made from; a stage does only
the videos without a valid one.  The settings are fixed by a manifest when a run begins.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import budget, change, publish, seeds, select, vectors

STAGES = ("candidates", "vectors", "views")


class Run:
    """``root`` is a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, settings: Settings, shots: DataFrame, videos: DataFrame) -> None:
        self.spark, self.root, self.settings, self.shots, self.videos = spark, root, settings, shots, videos
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")  # video ids are strings

    def _read(self, name: str) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.parquet(f"{self.root}/{name}") if there else None

    def digests(self, name: str) -> DataFrame | None:
        """Per video a digest of the stored rows, in any order of files."""
        rows = self._read(name)
        if rows is None:
            return None
        return self._digest(rows, name)

    def _digest(self, rows: DataFrame, name: str) -> DataFrame:
        """video_id, stage, sha256 of all videos of the run; one without rows has the digest of none."""
        each = F.xxhash64(*[F.to_json(F.struct(c)) if k.startswith(("array", "struct")) else F.col(c) for c, k in rows.dtypes if c != "video_id"])
        per = rows.groupBy("video_id").agg(F.count("*").alias("rows"), F.sum(each.cast("decimal(38,0)")).alias("mark"))
        per = self.videos.select("video_id").join(per, "video_id", "left")
        text = F.concat_ws(":", F.coalesce("rows", F.lit(0)).cast("string"), F.coalesce(F.col("mark").cast("string"), F.lit("0")))
        return per.select("video_id", F.lit(name).alias("stage"), F.sha2(text, 256).alias("sha256"))

    def _inputs(self, sources: list[DataFrame]) -> DataFrame:
        """Per video one digest of its rows in all the sources."""
        out = self.videos.select("video_id").withColumn("made_from", F.lit(self.settings.fingerprint))
        for i, rows in enumerate(sources):
            mark = self._digest(rows, str(i)).select("video_id", F.col("sha256").alias("one"))
            out = out.join(mark, "video_id").withColumn("made_from", F.sha2(F.concat("made_from", "one"), 256)).drop("one")
        return out

    def left(self, name: str, sources: list[DataFrame] | None = None) -> DataFrame:
        """Videos for which the stage has no valid checkpoint of these settings, or one made from other rows."""
        marks, actual = self._read(f"checkpoints/{name}"), self.digests(name)
        if marks is None or actual is None:
            return self.videos.select("video_id")
        if sources is not None:
            marks = marks.join(self._inputs(sources), ["video_id", "made_from"], "left_semi")
        return publish.todo(self.videos.select("video_id"), marks, actual, self.settings.fingerprint, name)

    def stage(self, name: str, work: Callable[[DataFrame], DataFrame], sources: list[DataFrame]) -> DataFrame:
        """Do the stage for the videos left (``work`` gets them), replace their rows, and checkpoint them alone."""
        self.left(name, sources).write.mode("overwrite").parquet(f"{self.root}/todo/{name}")  # what it is read from changes now
        some = self._read(f"todo/{name}")
        if some.isEmpty():
            return self._read(name)
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        work(some).write.partitionBy("video_id").mode("overwrite").parquet(f"{self.root}/{name}")
        marks = self.digests(name).join(some, "video_id", "left_semi").join(self._inputs(sources), "video_id")
        marks.withColumn("fingerprint", F.lit(self.settings.fingerprint)).write.partitionBy("video_id").mode("overwrite").parquet(f"{self.root}/checkpoints/{name}")
        return self._read(name)

    def execute(self, metrics: DataFrame, encoded: DataFrame) -> DataFrame:
        """From decoded metrics and vectors of all frames to the flat index, published last."""
        self.guard()
        of = lambda rows, some: rows.join(some, "video_id", "left_semi")
        s = self.settings
        seed_rows = seeds.seeds(self.shots, s)
        capacity = budget.capacities(seed_rows)
        planned = budget.plan(capacity, s.target_embedding_rows)
        rows = self.stage("candidates", lambda some: budget.admitted(change.enriched(of(seed_rows, some), of(metrics, some), s), planned), [self.shots, metrics, planned])
        vecs = self.stage("vectors", lambda some: of(encoded, some).join(rows.select("video_id", "frame_idx"), ["video_id", "frame_idx"], "left_semi"), [rows, encoded])

        def views(some: DataFrame) -> DataFrame:
            mine = of(rows, some)
            twins = vectors.semantic_duplicates(mine.join(vecs.select("video_id", "frame_idx", "embedding"), ["video_id", "frame_idx"]), s)
            return select.select_views(mine, self.shots, self.videos, twins, s)

        chosen = self.stage("views", views, [rows, vecs])
        lacking = publish.missing(of(self.videos, self.shots.select("video_id").distinct()), chosen.select("video_id").distinct())
        first = [r.video_id for r in lacking.orderBy("video_id").limit(5).collect()]
        if first:
            raise RuntimeError(f"no selection for {first}")
        index = publish.flat_index(publish.keyframes(chosen, self.shots, self.videos)).join(vecs.select("video_id", "frame_idx", "embedding"), ["video_id", "frame_idx"], "left")
        index.write.mode("overwrite").parquet(f"{self.root}/index")
        index = self._read("index")
        row = index.agg(F.count("*").alias("rows"), F.count("embedding").alias("vectors"), F.count_distinct("video_id").alias("videos")).first()
        if row.rows != row.vectors:
            raise RuntimeError(f"{row.rows - row.vectors} rows of the index have no vector")
        self._publish({"status": "frozen", "rows": row.rows, "videos": row.videos} | self._settings())
        return index

    def _settings(self) -> dict:
        return {"settings": asdict(self.settings), "config_fingerprint": self.settings.fingerprint, "encoder_fingerprint": self.settings.encoder_fingerprint}

    def _write_text(self, name: str, text: str) -> None:
        """One file below the root, in place of the old one."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path, part = hadoop.Path(f"{self.root}/{name}"), hadoop.Path(f"{self.root}/{name}.part")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = files.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        files.delete(path, False)
        files.rename(part, path)

    def _read_text(self, name: str) -> str | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.root}/{name}")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.text(f"{self.root}/{name}", wholetext=True).first()[0] if there else None

    def guard(self) -> None:
        """Begin the run, or go on with it if it was begun with the same settings."""
        before = self._read_text("run.json")
        if before is None:
            self._write_text("run.json", json.dumps(self._settings(), sort_keys=True))
        elif json.loads(before) != self._settings():
            raise RuntimeError("the run was begun with other settings")

    def _publish(self, manifest: dict) -> None:
        """The manifest, and only then the pointer that names it with its digest."""
        text = json.dumps(manifest, sort_keys=True)
        self._write_text("manifest.json", text)
        self._write_text("CURRENT.json", json.dumps({"manifest": "manifest.json", "sha256": hashlib.sha256(text.encode()).hexdigest()}))

    def recover(self, name: str, work: Callable[[DataFrame], DataFrame], sources: list[DataFrame]) -> dict:
        """Do the stage video by video for those left; one that fails does not stop the others."""
        todo, failures = sorted(r.video_id for r in self.left(name, sources).collect()), {}
        for video in todo:
            one = Run(self.spark, self.root, self.settings, self.shots, self.videos.filter(F.col("video_id") == video))
            try:
                one.stage(name, work, sources)
            except Exception as error:  # noqa: BLE001  reported, by video
                failures[video] = f"{type(error).__name__}: {error}"[:500]
        return {"status": "partial" if failures else "complete", "tried": len(todo), "failures": failures}

    def status(self) -> DataFrame:
        out = None
        for name in STAGES:
            marks = self._read(f"checkpoints/{name}")
            rows = (marks if marks is not None else self.videos.limit(0).select("video_id", F.lit(name).alias("stage"))).select("video_id", "stage")
            out = rows if out is None else out.unionByName(rows)
        return publish.status(self.videos.select("video_id"), out)


def main(arguments: list[str] | None = None) -> None:
    """Run the stages over the driver's tables, or show how far a run is."""
    from ..config import SMALL
    from . import fixtures

    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("command", choices=("run", "status"))
    parser.add_argument("--tables", required=True)
    parser.add_argument("--root", required=True)
    asked = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    run = Run(spark, asked.root, SMALL, fixtures.shots(spark, asked.tables), fixtures.videos(spark, asked.tables))
    if asked.command == "run":
        run.execute(fixtures.metrics(spark, asked.tables), fixtures.vectors(spark, asked.tables)).groupBy().count().show()
    run.status().show()


if __name__ == "__main__":
    main()
