"""The queries over ``documents``: one per operator, with the columns of its digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, minhash, packing, pii, quality_crf, quality_rules, substring_dedup, suffix_dedup, toxicity


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    return found.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"), pattern(), with_ids=False)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), pattern(), with_ids=False)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(documents(spark, sf_dir))
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1,
    "op2_quality_crf": op2,
    "op3_quality_rules": op3,
    "op4_byte_bpe": op4,
    "op5_best_fit_packing": op5,
    "op6_minhash_dedup": op6,
    "op7_exact_dedup": op7,
    "op8_pii": op8,
    "op9_toxicity": op9,
    "op10_substring_dedup": op10,
}

_SQL_7 = """
with t as (select doc_id, coalesce("text", '') as x from documents),
g as (select x, max(doc_id) as keep_id, count(*) as group_size from t group by x)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.x) as text_sha256 from t join g on g.x = t.x
"""

_SQL_10 = r"""
with w as (select doc_id, list_filter(string_split(translate(coalesce("text", ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda y: y <> '') as words from documents),
p as (select doc_id, words, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50),
h as (select doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as k from p),
f as (select k, min(doc_id) as first from h group by k having min(doc_id) < max(doc_id)),
r as (select h.doc_id, h.i from h join f on f.k = h.k where h.doc_id > f.first),
c as (select distinct doc_id, i + unnest(range(0, 50)) as j from r),
x as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as j from w),
k as (select x.doc_id, count(*) as kept, string_agg(word, ' ' order by x.j) as s from x left join c on c.doc_id = x.doc_id and c.j = x.j where c.j is null group by x.doc_id)
select w.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(k.kept, 0))::bigint as n_removed, sha256(coalesce(k.s, '')) as kept_sha256
from w left join k on k.doc_id = w.doc_id
"""

SQL: dict[str, str] = {"op3_quality_rules": quality_rules.SQL, "op7_exact_dedup": _SQL_7, "op10_substring_dedup": _SQL_10}
