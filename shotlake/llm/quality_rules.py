"""Line-first quality rules, in DataFrame functions only.

Each line is judged alone: a navigation line (fields between bars), a boilerplate
line (licence and site phrases), a line without words or without sentence
punctuation whose signs, capitals or length are not those of prose, and a line
that an earlier one equals are removed.  A document that loses more than
``MOST_LOST`` of its word characters, repeated lines included, or that fails a base
rule, is rejected.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, shielded, text_or_empty

#: ASCII white space, which separates words.
BLANKS = " \t\n\u000b\u000c\r"
SIGNS = "#*$%&|<>"
MOST_LOST = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50
#: Phrases of lines that are no text of the document itself, in the languages of the corpus.
BOILERPLATE = (
    "all rights reserved",
    "released under the",
    "licensed under",
    "terms of service",
    "terms and conditions",
    "privacy policy",
    "cookie policy",
    "copyright (c)",
    "sign up for",
    "click here",
    "todos los derechos reservados",
    "bajo licencia",
    "política de privacidad",
    "política de cookies",
    "términos y condiciones",
    "haga clic aquí",
    "tous droits réservés",
    "sous licence",
    "politique de confidentialité",
    "politique de cookies",
    "conditions générales",
    "cliquez ici",
    "alle rechte vorbehalten",
    "lizenziert unter",
    "datenschutzerklärung",
    "cookie-richtlinie",
    "allgemeine geschäftsbedingungen",
    "klicken sie hier",
)


def _solid(text: Column) -> Column:
    """The text without white space."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _signs(text: Column, signs: str) -> Column:
    """How many of the characters ``signs`` the text has."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{signs}]", ""))


def _with_repeated_words(base: DataFrame) -> DataFrame:
    """Add _n_repeat_words: words in 3-word windows that stand twice or more.

    Where not all windows' hashes differ, they are sorted with their places; of
    neighbours with equal hashes the words are compared, so that a text of any length
    is counted right.
    """
    n = F.size("_words")
    window = lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    base = base.withColumn("_hashes", F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), window)))
    placed = F.sort_array(F.transform("_hashes", lambda x, i: F.struct(x.alias("hash"), i.alias("i"))))
    base = base.withColumn("_keys", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), placed))
    alike = lambda a, b, k: F.get("_words", a["i"] + k) == F.get("_words", b["i"] + k)
    same = F.zip_with("_keys", F.slice("_keys", F.lit(2), F.size("_keys")), lambda a, b: (a["hash"] == b["hash"]) & alike(a, b, 0) & alike(a, b, 1) & alike(a, b, 2))
    base = base.withColumn("_same", same)
    no = F.lit(False)
    twice = F.filter("_keys", lambda x, i: F.coalesce(F.get("_same", i), no) | F.coalesce(F.get("_same", i - 1), no))
    base = base.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    widths = F.transform("_starts", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("_starts", i + 1) - x, F.lit(3))))
    covered = F.aggregate(widths, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return base.withColumn("_n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base figures, prefixed by an underscore, and the lines with their figures."""
    base = docs.withColumn("_text", text_or_empty()).withColumn("_words", words_of(F.col("_text")))
    base = _with_repeated_words(base.withColumn("_n_words", F.size("_words").cast("bigint")))
    base = base.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    base = base.withColumn("_different", F.array_distinct("_lines"))
    base = base.withColumn("_n_dup_lines", (F.size("_lines") - F.size("_different")).cast("bigint"))
    base = base.withColumn("_word_chars", F.length(_solid(F.col("_text"))).cast("bigint"))
    base = base.withColumn("_n_symbols", _signs(F.col("_text"), SIGNS).cast("bigint"))
    judged = F.transform("_different", lambda x: F.struct(x.alias("line"), F.length(_solid(x)).cast("bigint").alias("size"), _signs(x, "|").alias("bars"), _signs(x, SIGNS + "!").alias("signs")))
    base = base.withColumn("_judged", judged)
    return base.withColumn("_kept_lines", F.filter("_judged", passes))


def passes(x: Column) -> Column:
    """Whether a line is kept, judged by itself."""
    line, size, bars = x["line"], x["size"], x["bars"]
    navigation = (bars >= 3) | ((bars >= 1) & (size < 80))
    boilerplate = (size < 200) & F.lower(line).rlike("|".join(re.escape(p) for p in BOILERPLATE))
    noisy = x["signs"] * 20 > size
    shouting = (size >= 20) & ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}")
    bare = (size < 20) & ~F.rtrim(line).rlike("[.!?:;\"'»”)]$")
    return ~(navigation | boilerplate | noisy | shouting | bare)


@shielded
def quality_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost, cleaned_text.

    A null text counts as empty and fails for want of words.  Repeated rows are judged
    alike, each by itself; an empty table gives an empty one.  Columns of ``docs`` with
    one of these names are replaced.
    """
    base = measured(docs)
    base = base.withColumn("_left", F.aggregate("_kept_lines", F.lit(0).cast("bigint"), lambda a, x: a + x["size"]))
    failed = (F.col("_n_words") < LEAST_WORDS) | (F.col("_n_repeat_words") * 100 > F.col("_n_words") * MOST_REPEATED)
    base = base.withColumn("_lost", F.when(F.col("_word_chars") > 0, 1 - F.col("_left") / F.col("_word_chars")).otherwise(F.lit(0.0)))
    out = {k: F.col(f"_{k}") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost")}
    out |= {"base_failed": failed, "kept": ~failed & (F.col("_lost") <= MOST_LOST), "cleaned_text": F.concat_ws("\n", F.transform("_kept_lines", lambda x: x["line"]))}
    return base.select(*[F.col(c) for c in docs.columns if c not in out], *[v.alias(k) for k, v in out.items()])


@shielded
def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``quality_rules``."""
    return fenced(quality_rules(docs), "kept")


#: DuckDB SQL of the same rows, for a table ``documents``.
SQL = r"""
with t as (select doc_id, coalesce("text", '') as x from documents),
w as (select doc_id, x, list_filter(string_split(translate(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda y: y <> '') as words,
  list_filter(string_split(x, chr(10)), lambda y: length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0) as lines from t),
p as (select doc_id, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
g as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as k from p),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from g) where c > 1),
c as (select doc_id, count(*) as n from (select distinct doc_id, i + unnest([0, 1, 2]) as j from r) group by doc_id),
l as (select doc_id, x, words, lines, list_distinct(lines) as different from w),
m as (select *, list_filter(different, lambda y: not (
  (length(y) - length(translate(y, '|', '')) >= 3 or (length(y) - length(translate(y, '|', '')) >= 1 and length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) < 80))
  or (regexp_matches(lower(y), '{phrases}') and length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) < 200)
  or (length(y) - length(translate(y, '#*$%&|<>!', ''))) * 20 > length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))
  or (length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) >= 20 and not regexp_matches(y, '\p{Ll}') and regexp_matches(y, '\p{Lu}'))
  or (not regexp_matches(rtrim(y, ' '), '[.!?:;"''»”)]$') and length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) < 20))) as good from l),
q as (select m.doc_id, len(words)::bigint as n_words, length(translate(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::bigint as word_chars,
  (length(x) - length(translate(x, '#*$%&|<>', '')))::bigint as n_symbols, (len(lines) - len(different))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
  coalesce(list_sum(list_transform(good, lambda y: length(translate(y, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')))), 0) as left_over
  from m left join c on c.doc_id = m.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and (word_chars = 0 or 1 - left_over / word_chars <= 0.5) as kept from q
""".replace("{phrases}", "|".join(re.escape(p) for p in BOILERPLATE))
