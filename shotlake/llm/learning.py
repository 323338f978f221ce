"""Labelled samples and logistic calibration for the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

#: Labelled documents of each class that a model is fitted on at most, chosen by hash.
SAMPLE = 2500
#: What a class's sample may cost at most, where a character costs 1 and a line ``LINE_COST`` (its features).
SAMPLE_COST = 32_000_000
LINE_COST = 100


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE, cost: int = SAMPLE_COST) -> list[tuple[str, int]]:
    """A bounded sample of (text, label) that leaves held-out rows alone, in a fixed order.

    Of each class at most ``most`` documents, chosen by a hash of the id, and of those
    in that order as many as cost ``cost`` together; texts of any length may be among
    them.  A doc_id with both labels is in no sample; of rows that repeat a doc_id the
    one with the least text is taken.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
    known = known.filter("label = other").select("doc_id", "label", F.xxhash64("doc_id").alias("place"))
    picked = [known.filter(F.col("label") == v).orderBy("place", "doc_id").limit(most) for v in (0, 1)]
    few = materialize(picked[0].unionByName(picked[1]), "sample")  # at most twice ``most`` rows
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(few), "doc_id")
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    sizes = texts.select("doc_id", "label", "place", (F.length("text") + LINE_COST * lines).cast("bigint").alias("cost"))
    sizes = sizes.groupBy("label", "place", "doc_id").agg(F.max("cost").alias("cost"))
    total = F.sum("cost").over(Window.partitionBy("label").orderBy("place", "doc_id"))
    chosen = sizes.withColumn("total", total).filter(F.col("total") <= cost).select("doc_id")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return sorted((r["text"], r["label"]) for r in rows.select("text", "label").collect())


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the last one is the bias), by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty * max(len(x), 1))
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
