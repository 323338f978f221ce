"""Personal data: base detectors and information-theoretic sanitisation, in DataFrame functions only.

The base kinds come from patterns with checks.  Two measures of information add
spans: a string of letters and digits whose own information content (its length
times the entropy of its characters) is that of a credential, ``SECRET_BITS`` or
more (``secret``), and a term that reveals a protected entity (``term``): of the
documents with the term so many hold the entity that their mutual information
reaches ``DISCLOSED`` of the entity's information content.  Only terms that could
identify (with a capital or a digit) count.  The two may stand anywhere in a
document, and all documents count, those with an entity once for each text.  That
so many agree by chance must be less likely than ``CHANCE`` over all pairs tried
(Bonferroni).

Long texts: places, and the text without the spans, come from running figures over
blocks of ``BLOCK`` elements, so that neither copies what came before for each span.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, fits, lookup, materialize, shielded, small, text_or_empty

#: The kinds in their order, with their patterns.  Possessive
#: quantifiers match what the plain ones would, without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+"
#: A random string of 20 letters and digits has about 75 bits; of what people type at that length, hardly any has.
SECRET_BITS = 64.0
HINTS = {"email": "@", "phone": "+"}
BASE = tuple(PATTERNS)
KINDS = (*BASE, "secret", "term")
DISCLOSED = 0.95
CHANCE = 0.01
SPAN = "array<struct<start:int,end:int,value:string>>"
#: Elements of an array that are folded at once, and characters of a text that are cut at once.
BLOCK = 256
CUT = 4096
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _folded(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running figures of a short array of ints (0 or more) under ``join``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda s, x: F.struct(join(s["at"], x).alias("at"), F.concat(s["out"], F.array(join(s["at"], x))).alias("out"))
    return F.aggregate(values, start, step, lambda s: s["out"])


def _running(df: DataFrame, name: str, values: Column, join: Callable[[Column, Column], Column] = operator.add) -> DataFrame:
    """``df`` with a column ``name``: the running figures of an array of ints (0 or more) under ``join``."""
    df = df.withColumn("_values", values)
    last = F.floor((F.size("_values") - 1) / BLOCK).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda b: _folded(F.slice("_values", b * BLOCK + 1, F.lit(BLOCK)), join))
    df = df.withColumn("_parts", F.when(F.size("_values") > 0, parts))
    tops = _folded(F.transform("_parts", lambda x: F.element_at(x, -1)), join)
    df = df.withColumn("_before", F.concat(F.array(F.lit(0)), F.slice(tops, 1, F.size("_parts") - 1)))
    whole = F.flatten(F.zip_with("_parts", "_before", lambda x, b: F.transform(x, lambda v: join(b, v))))
    return df.withColumn(name, F.when(F.size("_values") > 0, whole).otherwise(F.array().cast("array<int>"))).drop("_values", "_parts", "_before")


def _placed(df: DataFrame, name: str, text: str, pattern: Column, found: Column) -> DataFrame:
    """``df`` with a column ``name``: the spans of the matches ``found`` of ``pattern`` in the text, from the texts between them."""
    df = df.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    between = F.when(F.size("_found") > 0, F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size("_found"))).otherwise(F.array().cast("array<string>"))
    df = _running(df, "_ends", F.zip_with("_found", between, lambda v, g: F.length(v) + F.length(g)))
    spans = F.zip_with("_found", "_ends", lambda v, e: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
    return df.withColumn(name, spans.cast(SPAN)).drop("_found", "_ends")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _content(value: Column) -> Column:
    """Information content in bits: the length times the entropy of the characters."""
    size = F.length(value).cast("double")
    counts = F.transform(F.array_distinct(F.split(value, "")), lambda c: size - F.length(F.replace(value, c, F.lit(""))))
    return F.aggregate(F.filter(counts, lambda n: n > 0), F.lit(0.0), lambda a, n: a + n * F.log2(size / n))


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "secret":
        return _content(value) >= SECRET_BITS
    return F.lit(True)


def detected(df: DataFrame, text: str, kinds: dict[str, str]) -> DataFrame:
    """``df`` with a column of spans for each kind, named like the kind with an underscore."""
    for kind, pattern in kinds.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        df = _placed(df, "_spans", text, F.lit(pattern), F.when(F.col(text).contains(HINTS[kind]), found) if kind in HINTS else found)
        df = df.withColumn(f"_{kind}", F.filter("_spans", lambda s: _holds(kind, s["value"])))
    return df.drop("_spans")


def _terms(text: Column) -> Column:
    """The different words that could identify, without the signs around them."""
    words = F.transform(F.split(F.translate(text, "\t\n\u000b\u000c\r", "     "), " "), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 4) & w.rlike(r"^\p{Lu}|[0-9]")))


def _weights(texts: DataFrame) -> DataFrame:
    """Weights of the rows (rid, _xx) that don't count as one document: of copies of a text only the least rid
    counts, and of repeated rows, which have one rid, each counts for its share."""
    firsts = texts.groupBy("_xx").agg(F.min("rid").alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = lookup(texts, materialize(firsts, "copied"), ["_xx"], "n").groupBy("rid", "first").agg(F.count("*").alias("m"))
    return rows.select("rid", F.when(F.col("rid") == F.col("first"), 1 / F.col("m")).otherwise(F.lit(0.0)).alias("weight")).filter("weight < 1")


def _bits(both: Column, of: Column, holders: Column, total: int) -> Column:
    """Hoeffding's bound, in bits, on chance putting an entity into ``both`` or more of the ``of`` documents with a term."""
    a, p = both / of, holders / F.lit(float(total))
    rest = F.when(both < of, (1 - a) * F.log2((1 - a) / (1 - p))).otherwise(0.0)
    return of * (a * F.log2(a / p) + rest)


def disclosing_terms(texts: DataFrame, base: DataFrame) -> DataFrame:
    """Terms (column term) that reveal a protected entity, from all documents.

    ``texts`` has rid, _xx and text; ``base`` rid and the spans of the base kinds
    for those documents that have any.  Every entity is tried with every term of
    its documents; what is left out before pairs are made can't pass for any pair.
    """
    weights = materialize(_weights(texts.select("rid", "_xx").join(base.select("rid"), "rid", "left_semi")), "weights")
    if not weights.isEmpty():
        base = base.join(small(weights.filter("weight = 0")), "rid", "left_anti")
        texts = texts.join(small(weights), "rid", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0))).filter("weight > 0")
    else:
        texts = texts.withColumn("weight", F.lit(1.0))
    total = max(round(texts.agg(F.sum("weight")).first()[0] or 0.0), 1)
    entities = F.concat(*[F.transform(f"_{k}", lambda s: F.concat(F.lit(k + ":"), s["value"])) for k in BASE])
    holders = materialize(base.select("rid", F.explode(F.array_distinct(entities)).alias("entity")), "holders")
    terms = texts.select("weight", F.explode(_terms(F.col("text"))).alias("term"))
    held = texts.join(holders.select("rid").distinct(), "rid", "left_semi").dropDuplicates(["rid"])
    held = materialize(held.select("rid", F.explode(_terms(F.col("text"))).alias("term")), "held-terms")
    each = holders.groupBy("rid").agg(F.count("*").alias("e")).join(held.groupBy("rid").agg(F.count("*").alias("t")), "rid")
    tested = each.agg(F.sum(F.col("e").cast("double") * F.col("t"))).first()[0] or 0.0
    least = math.log2(max(tested, 1.0) / CHANCE)

    wanted = held.groupBy("term").agg(F.count("*").alias("docs_h")).filter(F.col("docs_h") * math.log2(total) >= least)
    wanted = materialize(wanted, "wanted-terms")
    if fits(wanted):
        terms = terms.join(F.broadcast(wanted), "term", "left_semi")
    with_term = terms.groupBy("term").agg(F.round(F.sum("weight")).cast("bigint").alias("docs_t")).join(small(wanted), "term")
    possible = (F.col("docs_h") >= F.col("docs_t") * total ** (DISCLOSED - 1)) & (F.col("docs_h") * F.log2(F.lit(float(total)) / F.col("docs_t")) >= least)
    with_term = materialize(with_term.filter(possible), "term-docs")
    known = holders.groupBy("entity").agg(F.count("*").alias("docs_c"))
    known = materialize(known.filter((F.col("docs_c") < total) & (F.col("docs_c") * F.log2(F.lit(float(total)) / F.col("docs_c")) >= least)), "entities")

    left = lookup(held, with_term, ["term"], "docs_h").select("rid", "term", "docs_t")
    both = left.join(lookup(holders, known, ["entity"], "docs_c"), "rid").filter(~F.contains(F.col("entity"), F.col("term")))
    both = both.groupBy("entity", "term").agg(F.count("*").alias("docs_ct"), F.first("docs_t").alias("docs_t"), F.first("docs_c").alias("docs_c"))
    content = F.log2(F.lit(float(total)) / F.col("docs_c"))
    mutual = F.log2(F.col("docs_ct") * float(total) / (F.col("docs_c").cast("double") * F.col("docs_t")))
    sure = _bits(F.col("docs_ct"), F.col("docs_t"), F.col("docs_c"), total) >= least
    return materialize(both.filter((mutual >= content * DISCLOSED) & sure).select("term").distinct(), "disclosing")


def _joined(kinds: tuple[str, ...]) -> Column:
    parts = [F.transform(f"_{k}", lambda s: F.concat(F.lit(k + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def _generalised(df: DataFrame, name: str, text: str) -> DataFrame:
    """``df`` with a column ``name``: the text with each span replaced by its kind in brackets.

    Spans that overlap go as one, under the kind of the first.
    """
    every = F.concat(*[F.transform(f"_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{k.upper()}]").alias("mark"))) for k in KINDS])
    df = _running(df.withColumn("_every", F.array_sort(every)), "_reach", F.transform("_every", lambda s: s["end"]), F.greatest)
    some = F.size("_every") > 0
    df = df.withColumn("_cuts", F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))))
    before = lambda i: F.coalesce(F.get("_reach", i - 1), F.lit(0))
    opens = F.filter(F.sequence(F.lit(0), F.size("_every") - 1), lambda i: (i == 0) | (F.get("_every", i)["start"] >= before(i)))
    df = df.withColumn("_opens", F.when(some, opens))

    def between(a: Column, b: Column) -> Column:
        first = F.floor(a / CUT).cast("int")
        whole = F.array_join(F.slice("_cuts", first + 1, F.floor(b / CUT).cast("int") - first + 1), "")
        return F.substring(whole, a - first * CUT + 1, b - a)

    pieces = F.transform("_opens", lambda i: F.concat(between(before(i), F.get("_every", i)["start"]), F.get("_every", i)["mark"]))
    left = F.concat(F.array_join(pieces, ""), between(F.element_at("_reach", -1), F.length(text)))
    return df.withColumn(name, F.when(some, left).otherwise(F.col(text))).drop("_every", "_reach", "_cuts", "_opens")


@shielded
def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_spans, spans and clean_text.

    Offsets are code points, ends exclusive.  A null text counts as empty and stays
    null in ``clean_text``.  Repeated rows and rows without a doc_id are rows like any
    other; an empty table gives an empty one.  Columns of ``docs`` with one of these
    names are replaced.
    """
    out = {f"n_{k}": F.size(f"_{k}").cast("bigint") for k in BASE}
    out |= {"base_spans": _joined(BASE), "spans": _joined(KINDS)}
    keyed = docs.withColumn("_text", text_or_empty()).withColumn("_xx", F.xxhash64("_text")).withColumn("_id", F.col("doc_id").cast("bigint"))
    found = detected(keyed, "_text", PATTERNS | {"secret": SECRET})

    texts = keyed.select("_id", "_xx", F.col("_text").alias("text")).withColumn("rid", F.xxhash64("_id", "_xx"))
    base = fenced(found, " or ".join(f"size(_{k}) > 0" for k in BASE)).select(F.xxhash64("_id", "_xx").alias("rid"), *[f"_{k}" for k in BASE]).dropDuplicates(["rid"])
    terms = disclosing_terms(texts, materialize(base, "base-spans"))
    if not terms.isEmpty():
        hits = texts.select("rid", F.explode(_terms(F.col("text"))).alias("term")).join(small(terms), "term")
        edge = r"[\p{L}\p{N}]"
        quoted = F.concat(F.lit("\\Q"), F.replace(F.col("term"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        longest_first = F.array_join(F.sort_array(F.collect_set(quoted), False), "|")
        hits = hits.groupBy(F.col("rid").alias("_rid")).agg(F.concat(F.lit(f"(?<!{edge})(?:"), longest_first, F.lit(f")(?!{edge})")).alias("_pattern"))
        hits = materialize(hits, "term-hits")
        found = found.withColumn("_key", F.xxhash64("_id", "_xx")).join(small(hits), F.col("_key") == F.col("_rid"), "left")
        found = _placed(found, "_term", "_text", F.col("_pattern"), F.when(F.col("_pattern").isNotNull(), F.regexp_extract_all("_text", F.col("_pattern"), F.lit(0))))
    else:
        found = found.withColumn("_term", F.array().cast(SPAN))
    found = _generalised(found, "_clean", "_text")
    out["clean_text"] = F.when(F.col("text").isNotNull(), F.col("_clean"))
    return found.select(*[F.col(c) for c in docs.columns if c not in out], *[v.alias(k) for k, v in out.items()])
