"""Five stages from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.llm import exact_dedup, minhash, packing, pii, quality_rules
from shotlake.llm.common import materialize
from shotlake.llm.queries import documents, pattern, tokenizer_file


def _with_text(operator: Callable[[DataFrame], DataFrame], docs: DataFrame, text: str) -> DataFrame:
    """What ``operator`` keeps of ``docs``, with the text in its column ``text``, and its length where there is n_chars."""
    plain = [c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)]
    new = {"text": F.col(text), "n_chars": F.length(text).cast("bigint")}
    found = operator(docs.toDF(*plain))
    return found.select(*[new.get(c, F.col(p)).alias(c) for c, p in zip(docs.columns, plain)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, then documents that fail a base rule or lose too much."""
    return _with_text(quality_rules.accepted, docs, "cleaned_text")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.dedup(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _with_text(pii.sanitise, docs, "clean_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), pattern())


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", privacy), ("packing", pack)]

#: SQL can't express the tokenizer and the packing; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
