"""Stages over videos as they arrive: each micro-batch is a set of whole videos."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def on_arrival(spark: SparkSession, folder: str, schema: str, work: Callable[[DataFrame, int], None], checkpoint: str, files: int = 100):
    """Start a query that hands new parquet files in ``folder`` to ``work`` and ends when all are done.

    A file holds all rows of its videos.  ``work`` may get a batch again after a
    failure (with the same number), so it has to overwrite what it wrote for it.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    return rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
