from __future__ import annotations

import functools
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shotlake.llm import bpe, bwt, common, exact_dedup, golomb, learning, minhash, packing, pii, quality_crf, quality_rules, substring_dedup, suffix_dedup, toxicity, windows
from shotlake.llm.components import components

RANKS, JSON, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
key = lambda row: tuple((x is None, str(x)) for x in row)
same = lambda a, b: sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def texts():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    passage, other = line(140), line(70)
    docs = [(i, line(r.randrange(60)) + "\n" + (passage if i % 2 else passage[r.randrange(60) :]) + " " + line(9)) for i in range(24)]
    docs += [(100 + i, passage.replace("a", "b", i) + " " + other) for i in range(8)]
    docs += [(200, None), (201, ""), (202, "  \n\t "), (None, passage), (203, passage), (203, passage), (204, passage.upper()), (205, "ab " * 900), (206, "x" * 1500), (207, "one two")]
    docs += [(208, "Write to a.b@c.de or 10.0.0.256, 1.2.3.4; 4111 1111 1111 1111 and +1 (212) 555-0100. " + line(60)), (209, "a@b.co_x@d.e 1 2 3 4 5 6 7 8 9 0 " * 40)]
    return docs


DOCS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "l", "s", 1, "x") for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, rid string, n string, n_chars bigint, spans string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_suffix(docs, empty):
    for wide in (256, 2):
        got = suffix_dedup.suffix_dedup(docs, wide=wide).select("doc_id", "n", "n_removed", F.size("spans"), "kept_sha256").collect()
        assert same(got, brute.suffix(DOCS))
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_suffix_goes_by_bytes_not_words(spark, tmp_path):
    """Passages of over 50 words that two documents share stay up to 399 bytes and go from 400 on, in both; n_bytes is the whole text's length."""
    from shotlake.llm import queries

    r = random.Random(13)
    passage = lambda n: (" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)))[:n]
    shared = [passage(n) for n in (330, 399, 400, 401)]
    rows = [(2 * k + i, "AB"[i] * 9 + p + "CD"[i] * 9) for k, p in enumerate(shared) for i in (0, 1)]
    assert all(len(p.split()) > 50 for p in shared)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1(spark, str(tmp_path)).collect()
    assert same(got, brute.suffix(rows))
    assert [(x.n_bytes, x.n_removed) for x in sorted(got)] == [(n + 18, n if n >= 400 else 0) for n in (330, 399, 400, 401) for _ in (0, 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=5), st.integers(1, 9))
def test_interval_expansion(strings, length):
    seen = defaultdict(int)
    for s in strings:
        for i in range(len(s) - length + 1):
            seen[s[i : i + length]] += 1
    want = [i + length <= len(s) and seen[s[i : i + length]] > 1 for s in strings for i in range(len(s))]
    assert bwt.repeated(strings, length).tolist() == want


def test_substring(docs, empty):
    got = substring_dedup.substring_dedup(docs).select("doc_id", "n", "n_removed", "kept_sha256").collect()
    assert same(got, brute.substring(DOCS))
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert substring_dedup.clean(docs).count() == len(DOCS)


def test_index_over_batches(spark, tmp_path):
    """Batches that come one by one to a kept index, reopened each time, give what one batch gives."""
    r = random.Random(11)
    line = lambda n: " ".join(r.choice("abcde") + str(r.randrange(300)) for _ in range(n))
    passages = [line(r.randrange(55, 130)) for _ in range(5)]
    rows = [(i, line(r.randrange(40)) + " " + " ".join(r.choice(passages)[r.randrange(90) :] + " " + line(r.randrange(20)) for _ in range(r.randrange(4)))) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substring_dedup.features(table, "word", 50, 12)
    ranges, live = None, set()
    for k in range(4):
        index = substring_dedup.FingerprintIndex(spark, str(tmp_path / "index"), fan=2)
        assert index.version == k and len(index.logs["anchors"]) <= 2
        part = f"doc_id between {15 * k} and {15 * k + 14}"
        some = index.add(found.filter(part), table.filter(f"doc_id < {15 * k + 15}"))
        ranges = some if ranges is None else ranges.unionByName(some)
        live.update(index.names["anchors"])
    assert live == {"anchors-1-0", "anchors-2-1", "anchors-3-3", "anchors-4-1"}  # the third run was compacted with those before it
    got = substring_dedup.remove(table, found, ranges, "word").select("doc_id", "n", "n_removed", "kept_sha256").collect()
    assert same(got, brute.substring(rows)) and sum(x.n_removed for x in got) > 500


def test_hits_are_verified(spark):
    """Hits whose words differ, as a clash of hashes would give, are dropped."""
    rows = [(i, " ".join(f"w{i if j == 60 else 0}.{j}" for j in range(120))) for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substring_dedup.features(table, "word", 50, 12)
    at = {x.doc_id: x for x in found.select("doc_id", "xx", "rid").collect()}
    hits = spark.createDataFrame([(at[1].rid, s, 5, 0, at[0].xx, s) for s in (0, 30, 65)], "rid bigint, s int, m int, o_doc bigint, o_xx bigint, o_s int")
    got = substring_dedup.FingerprintIndex(spark)._verified(table, found, hits).collect()
    assert sorted(map(tuple, got)) == [(at[1].rid, 0, 54), (at[1].rid, 65, 119)]


def test_many_repeated_rows(spark):
    r = random.Random(12)
    text = " ".join(str(r.randrange(500)) for _ in range(150))
    rows = [(7, text)] * 3000 + [(3, text + " end"), (9, "x " + text)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert same(substring_dedup.substring_dedup(table).select("doc_id", "n", "n_removed", "kept_sha256").collect(), brute.substring(rows))
    assert same(suffix_dedup.suffix_dedup(table).select("doc_id", "n", "n_removed", F.size("spans"), "kept_sha256").collect(), brute.suffix(rows))


def test_components(spark):
    random = np.random.default_rng(3)
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)]
    mixed = [(int(a), int(b)) for a, b in random.integers(200, 300, (70, 2))]
    for links in ([], [(5, 5)], star, star + [(131, 130)], path, path[::2] + [(b, a) for a, b in path[1::2]] + star + mixed * 2):
        near = {}
        for a, b in links:
            if a != b:
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
        least, expected = {}, set()
        for node in sorted(near):
            todo = [] if node in least else [node]
            while todo:
                x = todo.pop()
                if x not in least:
                    least[x] = node
                    todo += near[x]
            if least[node] != node:
                expected.add((node, least[node]))
        rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
        assert len(rows) == len(expected) and {(r.node, r.component) for r in rows} == expected


def test_near(docs, empty):
    got = minhash.near_dedup(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert same(got, brute.near(DOCS))
    assert minhash.near_dedup(empty).count() == 0
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns
    components = {x[2] for x in brute.near(DOCS) if x[1]} | {("alone", x[0]) for x in brute.near(DOCS) if not x[1]}
    assert kept.count() == len(components)


def test_exact(docs, empty):
    got = exact_dedup.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for i, t in DOCS:
        groups[t or ""].append(i)
    for row in got:
        mine = next(g for t, g in groups.items() if brute.sha(t.encode()) == row.text_sha256)
        assert row.group_size == len(mine) and row.keep_id == max(i for i in mine if i is not None)
    assert sum(r.kept for r in got) == len(groups) == exact_dedup.dedup(docs).count()
    assert exact_dedup.exact_dedup(empty).count() == 0


@given(st.sets(st.integers(1000, 99_999), max_size=200))
def test_golomb(values):
    v = np.array(sorted(values), np.int64)
    assert golomb.decode(golomb.encode(v, 1000, 99_000), len(v), 1000, 99_000).tolist() == v.tolist()


def test_rules(docs, empty):
    got = quality_rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert same(got, [(i, *brute.rules(t)) for i, t in DOCS])
    assert quality_rules.quality_rules(empty).count() == 0


def test_lines(spark):
    r = random.Random(6)
    prose = lambda n: " ".join(r.choice(["Some", "words", "of", "a", "sentence", "été", "größer", "77"]) + r.choice(["", "", "x", "yy"]) + str(r.randrange(999)) for _ in range(n)) + "."
    odd = ["Home | News | Sport | More", "Alle Rechte vorbehalten.", "TODOS LOS DERECHOS RESERVADOS", "Sous licence X.", "short", "ok.", "%%%% <<< >>>", "A LOUD LINE OF CAPITALS ONLY", "  ", "one | two", "“Quoted”"]
    rows = [(i, "\n".join(r.choice([prose(r.randrange(3, 40)), r.choice(odd)]) for _ in range(r.randrange(1, 30)))) for i in range(60)]
    rows += [(90, "\n".join([prose(30)] * 20)), (91, "\n".join([prose(70)] + odd)), (92, None), (93, ""), (94, "\n".join(odd)), (91, "\n".join([prose(70)] * 2))]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "cleaned_text", "kept").collect()
    assert same(got, [(i, *brute.cleaned(t, quality_rules.BOILERPLATE)) for i, t in rows])
    assert not any(x.kept for x in got if x.doc_id == 90)  # nearly all of it is one line again and again
    assert {x.doc_id for x in quality_rules.accepted(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {x.doc_id for x in got if x.kept}


def test_repeated_words_of_long_texts(spark):
    r = random.Random(9)
    long = [f"{r.randrange(1 << 40):x}" for _ in range(400_000)]
    long[300_000:300_005] = long[7:12]
    rows = [(1, " ".join(long)), (2, "a b c d a b c\te")]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert same(got, [(i, *brute.rules(t)) for i, t in rows])


def test_pii(docs, empty):
    got = pii.sanitise(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans").collect()
    assert same(got, [(i, *brute.pii(t)) for i, t in DOCS])
    clean = pii.sanitise(docs.filter("doc_id = 208")).first().clean_text
    assert "[EMAIL]" in clean and "[PHONE]" in clean and "4111" not in clean
    assert pii.sanitise(empty).count() == 0


def test_pii_edges(spark):
    r = random.Random(4)
    ips = ["10.0.0.1", "192.168.0.12", "0.0.0.0", "256.1.1.1", "1.2.3.256", "000.000.000.000", "01.002.0003.0", "255.255.255.255", "1.2.3", "1.2.3.4.5.6.7.8", "10.0.0.10.0"]
    rows = [(i, f"see {x} and é😀 a@b.co {x}, \\E") for i, x in enumerate(ips)]
    rows += [(50 + i, f"Line {i} of Zor\\Eblatt, card 4111 1111 1111 1111, he\nmore") for i in range(12)] + [(80 + i, "Nothing of note" + " on" * i) for i in range(60)]
    keys = ["9c8b45435718dcc700c184a7e303cdc64c6a8f7f", "a1" * 15, "Ab3dE5gH1jK2mN4pQ6rS", "a-1" + "b" * 30]
    rows += [(200, None), (201, ""), (202, "key " + " ok ".join(keys)), (203, "a@b.co_x@d.e +1 (212) 555-0100 10.0.0.1")]
    rows += [(300, "".join(r.choice(["é word ", "10.0.0.1 ", f"mail {r.randrange(99)}@x.de ", "\n", "+49 30 123456 "]) for _ in range(9000)))]  # several blocks of spans and cuts
    rows += [(301, rows[3][1]), (301, rows[3][1])]
    got = pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = dict(rows)
    for x in got:
        text = texts[x.doc_id]
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_spans) == brute.pii(text)
        assert x.clean_text == (None if text is None else brute.generalised(text, x.spans))
        assert ("term:" in x.spans) == (50 <= x.doc_id < 62)
    secrets = next(x.spans for x in got if x.doc_id == 202).count("secret:")
    assert len(got) == len(rows) and secrets == sum(brute.bits(k) >= pii.SECRET_BITS for k in keys) == 2


def test_broadcasts_are_measured(spark, docs):
    rows = spark.createDataFrame([("x" * 1000, [1, 2], [("y", 1)])] * 10, "a string, b array<bigint>, c array<struct<k:string,v:int>>")
    assert 10_000 < common.measured_bytes(rows) < 14_000
    assert not common.fits(rows, 9000) and common.measured_bytes(rows.limit(0)) == 0


def test_disclosing_terms(spark):
    rows = [(i, f"Line {i} of Zorblatt, card 4111 1111 1111 1111, he said.\nmore text") for i in range(8)] + [(50 + i, "Nothing of note was said here") for i in range(20)]
    got = pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(("term:" in r.spans) == (r.doc_id < 50) for r in got)
    assert all("Zorblatt" not in r.clean_text for r in got)


def test_disclosing_terms_of_few_documents(spark):
    line = "Signed Quimbly, q.b@mail.example.com"
    rows = [(i, f"{line}\nshe said {'so ' * (i + 1)}") for i in range(6)]  # one line, in different documents
    rows += [(20 + i, f"Vraxton\nnote {'on ' * (i + 1)}\nwrite to v.x@mail.example.com") for i in range(4)]  # few documents, two lines apart
    rows += [(30 + i, "Copied Wexford, w.w@mail.example.com") for i in range(9)]  # nine copies of one document
    rows += [(100 + i, f"nothing Common {'of note ' * (i + 1)}") for i in range(200)]
    clean = {r.doc_id: r.clean_text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all("Quimbly" not in clean[i] for i in range(6))
    assert all("Vraxton" not in clean[20 + i] for i in range(4))
    assert all("Wexford" in clean[30 + i] for i in range(9))
    assert all("Common" in clean[100 + i] for i in range(200))


def test_bpe(docs, empty):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    tool = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a   b \n  c  d  ", "<|endoftext|> it's 12 'll", " x", "日本 語!\x1c y", "." * 300]
    encoder = bpe.encoder(RANKS, PATTERN)
    for text in [t or "" for _, t in DOCS] + odd:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == tool.encode_ordinary(text) and encoder.decode(encoder.encode(text)) == text.encode()
    assert bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).filter("doc_id = 208").first().text == dict(DOCS)[208]
    assert bpe.encode(empty, RANKS, PATTERN).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=20), st.binary(max_size=9), st.integers(0, 20), st.integers(0, 20))
def test_prefixes(data, new, a, b):
    v = bpe.vocabulary(RANKS)
    start, end = sorted((min(a, len(data)), min(b, len(data))))
    p = bpe.Prefixes(v, data[:start])
    p.append(data[start:])
    p.replace(start, end, new)
    assert p.tokens() == bpe.Prefixes(v, data[:start] + new + data[end:]).tokens()


def packed(rows, docs, tool):
    """Checks the pieces and sequences of ``docs`` (id, text); gives the sequences' sizes."""
    pieces, bins, want = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and r.length == len(r.ids) // 4
    for i, t in docs:
        ids = np.array(tool.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        first = len(ids) // 4 - (len(ids) // 4 - 1) // 1024 * 1024
        cuts = [0, first, *range(first + 1024, len(ids) // 4 + 1, 1024)]
        want[i] += [(k, a, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {i: sorted(x) for i, x in want.items()} == {i: sorted((r.piece, r.start, r.ids) for r in x) for i, x in pieces.items()}
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    return [sum(n for _, n in members) for members in bins.values()]


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(JSON)
    packed(packing.pack(docs, JSON, PATTERN).collect(), DOCS, tool)
    r = random.Random(8)
    some = [(i % 250, None if i % 60 == 7 else "ab " * r.choice([0, 3, 200, 340, 350, 480, 700, 2500]) + "x<|endoftext|> y" * (i % 3)) for i in range(260)]
    spread = spark.createDataFrame(some, "doc_id bigint, text string").repartition(11)
    rows = packing.pack(spread, JSON, PATTERN, fan=2, slices=3).collect()
    sizes = packed(rows, some, tool)
    assert {x.sequence_id >> 58 for x in rows} >= {0, 4}  # bins went through four rounds of merging
    assert len(sizes) <= 1.02 * len(packing.best_fit([x.length for x in rows], 1024)) + 1
    assert packing.pack(empty, JSON, PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", " ", "  \n", "a", "é", "12", "'ll", "\u2028", "日本", "."]), max_size=12).map("".join))
def test_token_ids(text):
    assert packing.token_bytes([text], JSON, PATTERN)[0] == np.array(tokenizer().encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_fit_counts(sizes):
    kinds = packing.fit_counts(Counter(sizes), 40)
    assert Counter({s: sum(n * t for kind, n in kinds for x, t in kind if x == s) for s in set(sizes)}) == Counter(sizes)
    assert sorted(sum(s * t for s, t in kind) for kind, n in kinds for _ in range(n)) == sorted(sum(sizes[i] for i in b) for b in packing.best_fit(sizes, 40))


def test_best_fit():
    assert sorted(map(sorted, packing.best_fit([5, 4, 3, 3, 3, 2], 10))) == [[0, 1], [2, 3, 4]] + [[5]] or len(packing.best_fit([5, 4, 3, 3, 3, 2], 10)) == 2
    sizes = [random.Random(1).randrange(1, 100) for _ in range(300)]
    bins = packing.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 100 for b in bins)


def test_trained(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    all_docs = spark.read.parquet(f"{sf}/documents.parquet")
    for made, label, least in ((quality_crf.quality, "quality", 0.95), (toxicity.toxicity, "toxic", 0.9)):
        rows = made(all_docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
        assert sum(a == b for a, b in rows) / len(rows) >= least
        assert made(docs, labels).count() == len(DOCS) and made(empty, labels.limit(0)).count() == 0


def test_automaton():
    a = toxicity.Automaton({"worthless": 2, "idiot": 1, "scum": 0})
    words = {"worthless": 0, "worthles": 1, "wortless": 1, "w0rthl3ss": 2, "idiot": 0, "idi0t": 1, "idiots": 1, "scum": 0, "scam": -1, "idxxt": -1, "worthl": -1}
    raw = np.frombuffer(" ".join([*words, ""]).encode(), np.uint8)
    end = np.flatnonzero(raw == 32)
    start = np.concatenate([[0], end[:-1] + 1])
    assert a.run(raw, start, end - start).tolist() == list(words.values())


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(0, 2), min_size=1, max_size=4), st.lists(st.text("abéx", min_size=1, max_size=8), min_size=1, max_size=12))
def test_automaton_finds_all(terms, words):
    a = toxicity.Automaton(terms)
    raw = np.frombuffer(" ".join([*words, ""]).encode(), np.uint8)
    end = np.flatnonzero(raw == 32)
    start = np.concatenate([[0], end[:-1] + 1])
    want = []
    for w in words:
        near = [brute.distance(t.encode(), w.encode()) for t in terms]
        want.append(min((d for d, e in zip(near, terms.values()) if d <= e), default=-1))
    assert a.run(raw, start, end - start).tolist() == want


def test_toxic_words_in_capitals():
    r = random.Random(1)
    other = lambda n: " ".join("".join(r.choice("абвгде") for _ in range(6)) for _ in range(n))
    rows = [(f"{other(5)} дурак {other(5)} ДУРАК", 1) for _ in range(40)] + [(other(12), 0) for _ in range(40)]
    model = toxicity.fit(rows)
    texts = ["Ты ДУРАК, дурак", "Ты Дурак " * 3, other(9), "", "\n", "ДУРАКА Дура́к дурак"]
    assert [s >= 0.5 for s in toxicity.scores([t.encode() for t in texts], model)] == [True, True, False, False, False, True]
    one, many = toxicity.scores([b"", texts[0].encode()], model), toxicity.scores([texts[0].encode()] * 3 + [(other(60_000) + texts[0]).encode()], model)
    assert one[1] == many[0] == many[1] == many[2] > many[3]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=5), st.integers(0, 99))
def test_marginals(sizes, seed):
    random_ = np.random.default_rng(seed)
    bounds = np.cumsum([0, *sizes])
    scores, change = random_.normal(size=(bounds[-1], 2)), random_.normal(size=(2, 2))
    got, moves = quality_crf.marginals(scores, bounds, change)
    want = [brute.marginals(scores[a:b], change) for a, b in zip(bounds[:-1], bounds[1:])]
    assert np.allclose(got, np.concatenate([x for x, _ in want])) and np.allclose(moves, sum(x for _, x in want))


def test_sample(spark):
    docs = spark.createDataFrame([(i, "word " * (40_000 if i % 3 == 0 else 20), "x") for i in range(40)] + [(5, "word", "y"), (None, "n", "z")], "doc_id bigint, text string, place string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0), (7, 1), (8, 0), (9, None)], "doc_id bigint, quality int")
    out = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 and i != 7]
    rows = learning.sample(docs, labels, "quality")
    assert len(rows) == len(out) and sum(len(t) > 20_000 for t, _ in rows) == sum(i % 3 == 0 for i in out)
    few = learning.sample(docs, labels, "quality", cost=210_000)
    assert 0 < len(few) < len(rows) and sum(len(t) for t, _ in few) < 420_000
    assert sorted({y for _, y in learning.sample(docs, labels, "quality", most=3)}) == [0, 1] and len(learning.sample(docs, labels, "quality", most=3)) == 6


def test_clashing_columns(spark):
    import corpus_pipeline as c

    extra = ["_id", "_xx", "_text", "_kept", "_spans", "_term", "_fence", "own_1", "kept", "n_email", "clean_text", "cleaned_text", "a.b", "rid"]
    rows = [(i, t, *[f"{k}{i}" for k in extra]) for i, t in DOCS if i is not None and i < 203]
    clash = spark.createDataFrame(rows, f"doc_id bigint, text string, {', '.join(f'`{k}` string' for k in extra)}")
    steps = [lambda d, f=f: f(spark, d, "") for _, f in c.STAGES[:-1]] + [suffix_dedup.clean, substring_dedup.clean]
    for step in steps:
        out = step(clash)
        assert out.columns == clash.columns
        assert all(list(r)[2:] == [f"{k}{r.doc_id}" for k in extra] for r in out.collect())
    assert pii.sanitise(clash).columns[-1] == "clean_text" and quality_rules.quality_rules(clash).filter("kept").count() > 0


def test_long_texts(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8)))
    long = " ".join(word() for _ in range(60_000))
    rows = [(1, long), (2, long[:150_000] + " " + " ".join(word() for _ in range(9_000))), (3, long + " end"), (4, ""), (5, None), (6, long[1000:1900])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert same(substring_dedup.substring_dedup(docs).select("doc_id", "n", "n_removed", "kept_sha256").collect(), brute.substring(rows))
    assert same(suffix_dedup.suffix_dedup(docs).select("doc_id", "n", "n_removed", F.size("spans"), "kept_sha256").collect(), brute.suffix(rows))
    assert same(minhash.near_dedup(docs).select("doc_id", "n_shingles", "component_id").collect(), brute.near(rows))
    got = quality_rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert same(got, [(i, *brute.rules(t)) for i, t in rows])


def test_anchors_do_not_depend_on_what_follows():
    codes = windows.BYTE_CODES[np.frombuffer(b"ab" * 300 + bytes(random.Random(2).choices(range(97, 101), k=2000)), np.uint8)]
    short, long = (windows.runs(np.concatenate([codes, np.zeros(k, np.uint64)]), np.array([0, len(codes)] + [len(codes) + k] * (k > 0)), 400, 100) for k in (0, 300_000))
    mine = long[0] == 0
    assert all(np.array_equal(a, b[mine]) for a, b in zip(short, long))


def test_pipeline(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    step = rows
    for name, stage in c.STAGES[:-1]:
        before, step = step, c.materialize(stage(spark, step, sf), name)
        assert step.columns == rows.columns and step.count() <= before.count()
        texts = [(r.doc_id, r.text) for r in before.collect()]
        if name == "near_dedup":
            assert {r.doc_id for r in step.collect()} == {c_ if n else i for i, n, c_ in brute.near(texts)}
        if name == "exact_dedup":
            assert step.count() == len({t for _, t in texts})
    out = c.run(spark, sf)
    assert out.select("doc_id").distinct().count() == step.count()
