"""Toxicity: Levenshtein automata over a lexicon trie, scored in context windows.

The lexicon is learned from labelled documents: words that toxic ones have far
more often.  A walk through its trie that counts edits, made deterministic, is one
automaton for all terms within their edit distance; it runs over all words of a
batch side by side.  Each hit is scored in its context: quotation marks around it
and speech verbs before it tell quotation, address and repetition tell abuse; how
much each counts is learned from the labels.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty, utf8
from .learning import held_out, logistic, sample, sigmoid
from .windows import chunks

THRESHOLD = 0.5
#: How many times as common in toxic documents, and in which share of them (and how many), a term has to be.
LIFT = 20.0
SHARE = 0.006
LEAST = 4
CONTEXT = 48
CHUNK = 1 << 20
_WORD = re.compile(r"[^\W\d_]{3,24}")
#: Verbs and nouns that announce a quotation, and words of address, in the languages of the corpus.
SPEECH = ("said", "says", "wrote", "called", "quote", "quoted", "quotes", "word", "term", "dijo", "dice", "escribió", "llamó", "palabra", "término", "dit", "écrit", "écrivit", "appelé", "mot", "terme", "sagt", "sagte", "schrieb", "nannte", "wort", "begriff")
ADDRESS = ("you", "your", "you're", "u", "tú", "usted", "ustedes", "vous", "toi", "dich", "dir", "euch")
#: The features that count unquoted hits.
UNQUOTED = np.array([True, True, False, False, True])


def _any_of(words: tuple[str, ...]) -> bytes:
    return rb"(?<![a-z\x80-\xff])(?:" + "|".join(map(re.escape, words)).encode() + rb")(?![a-z\x80-\xff])"


_QUOTED = re.compile(_any_of(SPEECH) + rb"[^a-z0-9\x80-\xff]*$|[\"'\xab\x93]$|\xe2\x80[\x9c\x98\x9e]$")
_CLOSED = re.compile(rb"^[.,!?]?(?:[\"'\xbb]|\xe2\x80[\x9d\x99])")
_ADDRESS = re.compile(_any_of(ADDRESS))


def most_edits(term: str) -> int:
    """Edits allowed at most: none in short words, one in longer ones, two in the longest."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def lexicon(rows: list[tuple[str, int]]) -> dict[str, int]:
    """Terms, each with the edits allowed: as many as keep the words within them as telling as the term."""
    toxic, other, n = Counter(), Counter(), Counter(y for _, y in rows)
    for text, y in rows:
        (toxic if y else other).update(set(_WORD.findall(text.lower())))

    def lift(with_toxic: float, with_other: float) -> float:
        return (with_toxic / max(n[1], 1)) / ((with_other + 0.5) / max(n[0], 1))

    least = max(LEAST, SHARE * n[1])
    strong = sorted((w for w, c in toxic.items() if c >= least and lift(c, other[w]) >= LIFT), key=lambda w: (-toxic[w], w))
    words = sorted(toxic.keys() | other.keys())
    raw = np.frombuffer(" ".join([*words, ""]).encode(), np.uint8)
    end = np.flatnonzero(raw == 32)
    start = np.concatenate([[0], end[:-1] + 1])
    in_toxic, in_other = (np.array([c[w] for w in words]) for c in (toxic, other))
    out = {}
    for term in sorted(strong):
        for allowed in range(most_edits(term), -1, -1):
            edits = Automaton({term: allowed}).run(raw, start, end - start)
            near = edits > 0
            if not in_other[near].sum() or lift(in_toxic[near].sum(), in_other[near].sum()) >= LIFT:
                out[term] = allowed
                break
    return out


class Automaton:
    """A deterministic automaton that accepts words within the edits (of UTF-8 bytes) allowed for a term.

    ``table[state, symbol]`` is the next state (0 is dead, 1 the start), where a
    symbol is a byte of the lexicon or 0 for all others; ``accept[state]`` is the
    edits spent on the nearest term, or -1.
    """

    def __init__(self, edits: dict[str, int]) -> None:
        limits = {t.encode(): e for t, e in edits.items()}
        terms, edits_for = sorted(limits), limits.__getitem__
        letters = sorted({c for t in terms for c in t})
        self.symbol = np.zeros(256, np.int64)
        for i, c in enumerate(letters):
            self.symbol[c] = i + 1
        children: list[dict[int, int]] = [{}]
        allowed, ends = [0], [False]  # the most edits of any term below a node
        for term in terms:
            at = 0
            allowed[0] = max(allowed[0], edits_for(term))
            for c in term:
                s = int(self.symbol[c])
                if s not in children[at]:
                    children[at][s] = len(children)
                    children.append({})
                    allowed.append(0)
                    ends.append(False)
                at = children[at][s]
                allowed[at] = max(allowed[at], edits_for(term))
            ends[at] = True
            allowed[at] = max(allowed[at], edits_for(term))
        limit = {}  # of the term that ends at a node
        for term in terms:
            at = 0
            for c in term:
                at = children[at][int(self.symbol[c])]
            limit[at] = edits_for(term)

        def closed(places: dict[int, int]) -> frozenset:
            """With the places reached by leaving out letters of a term."""
            todo = list(places.items())
            while todo:
                node, spent = todo.pop()
                if places.get(node, 99) < spent:
                    continue
                for child in children[node].values():
                    if spent + 1 <= allowed[child] and spent + 1 < places.get(child, 99):
                        places[child] = spent + 1
                        todo.append((child, spent + 1))
            return frozenset(places.items())

        start = closed({0: 0})
        number, states, rows = {frozenset(): 0, start: 1}, [frozenset(), start], []
        for state in states:  # grows while it is gone through
            row = []
            for s in range(len(letters) + 1):
                places: dict[int, int] = {}

                def reach(node: int, spent: int, places=places) -> None:
                    if spent <= allowed[node] and spent < places.get(node, 99):
                        places[node] = spent

                for node, spent in state:
                    reach(node, spent + 1)
                    for symbol, child in children[node].items():
                        reach(child, spent + (symbol != s))
                target = closed(places)
                if target not in number:
                    number[target] = len(states)
                    states.append(target)
                row.append(number[target])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        spent = [min([e for node, e in state if ends[node] and e <= limit[node]], default=-1) for state in states]
        self.accept = np.array(spent, np.int64)
        self.shortest = min([len(t) - edits_for(t) for t in terms], default=99)
        self.longest = max([len(t) + edits_for(t) for t in terms], default=0)

    def run(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each word the edits to the nearest term, or -1."""
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero((size >= self.shortest) & (size <= self.longest))
        state = np.ones(len(live), np.int32)
        for t in range(self.longest + 1):
            done = size[live] == t
            out[live[done]] = self.accept[state[done]]
            live, state = live[~done], state[~done]
            if not len(live):
                break
            state = self.table[state, self.symbol[raw[start[live] + t]]]
            alive = state > 0
            live, state = live[alive], state[alive]
        return out


_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def solid_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are letters or digits, or parts of one."""
    solid = _SOLID[raw]
    sign = np.flatnonzero(raw[:-1] == 0xC2)  # Latin-1 signs
    solid[sign] = solid[sign + 1] = False
    sign = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x80))  # general punctuation
    for i in range(3):
        solid[sign + i] = False
    return solid


def hits_of(joined: bytes, automaton: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and edits of the words (letters, digits, and signs between them) that match, in a text in lower case."""
    raw = np.frombuffer(joined, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    solid = np.flatnonzero(solid_bytes(raw))
    if not len(solid):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = np.cumsum(blank)[solid]
    first = np.concatenate([[True], word[1:] != word[:-1]])
    last = np.concatenate([first[1:], [True]])
    start, end = solid[first], solid[last] + 1
    whole = automaton.run(raw, start, end - start)
    # a word glued to others by signs is also tried part by part
    gap = np.concatenate([[True], np.diff(solid) > 1])
    last = np.concatenate([gap[1:], [True]])
    part_start, part_end = solid[gap], solid[last] + 1
    parts = automaton.run(raw, part_start, part_end - part_start)
    found = {}
    for s, e, d in ((start, end, whole), (part_start, part_end, parts)):
        for i in np.flatnonzero(d >= 0).tolist():
            found[int(s[i])] = min(found.get(int(s[i]), (int(e[i]), 9)), (int(e[i]), int(d[i])), key=lambda x: x[1])
    at = np.array(sorted(found), np.int64)
    return at, np.array([found[i][0] for i in at.tolist()], np.int64), np.array([found[i][1] for i in at.tolist()], np.int64)


def features_of(data: list[bytes], automaton: Automaton) -> np.ndarray:
    """Per text: exact, misspelled and quoted hits, hits with address, hits per 100 words (all damped).

    Texts are compared in lower case, as the lexicon is, by the rules of Unicode.
    """
    out = np.zeros((len(data), 5))
    for piece in chunks([len(x) for x in data], CHUNK):
        some = [x.decode("utf-8", "replace").lower().encode() for x in data[piece]]
        joined = b"\n".join(some)
        at, end, edits = hits_of(joined, automaton)
        if not len(at):
            continue
        bounds = np.cumsum([0] + [len(x) + 1 for x in some])
        owner = np.searchsorted(bounds, at, "right") - 1
        for s, e, d, o in zip(at.tolist(), end.tolist(), edits.tolist(), owner.tolist()):
            low, high = max(int(bounds[o]), s - CONTEXT), min(int(bounds[o + 1]) - 1, e + CONTEXT)
            before, after = joined[low:s], joined[e:high]
            quoted = bool(_QUOTED.search(before.rstrip(b" ") if not before.endswith(b'"') else before)) and bool(_CLOSED.search(after) or not before.endswith((b'"', b"'")))
            row = out[piece.start + o]
            row[0 if d == 0 else 1] += 0 if quoted else 1
            row[2] += quoted
            row[3] += (not quoted) and bool(_ADDRESS.search(before) or _ADDRESS.search(after))
            row[4] += not quoted
    words = np.array([max(1, x.count(b" ") + x.count(b"\n") + 1) for x in data])
    out[:, 4] = 100 * out[:, 4] / words
    return np.log1p(out)


def fit(rows: list[tuple[str, int]]) -> dict:
    labels = np.array([y for _, y in rows], float)
    terms = lexicon(rows)
    if not terms or len(set(labels.tolist())) < 2:
        return {"constant": float(labels.mean()) if len(labels) else 0.0}
    automaton = Automaton(terms)
    x = features_of([t.encode() for t, _ in rows], automaton)
    return {"terms": terms, "automaton": automaton, "w": weights(x, labels)}


def weights(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Learned weights of the features; none of unquoted hits is negative, as a hit is no sign of a clean text.

    Those of the context (quotation, address) are what the labels say; without labelled cases they are 0.
    """
    use = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1] + 1)
        w[np.append(use, True)] = logistic(x[:, use], labels)
        wrong = (w[:-1] < 0) & UNQUOTED
        if not wrong.any():
            return w
        use &= ~wrong


def scores(data: list[bytes], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(data), model["constant"])
    return sigmoid(features_of(data, model["automaton"]) @ model["w"][:-1] + model["w"][-1])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Null texts are scored as empty ones, repeated rows alike; an empty table gives an
    empty one.  Without labelled rows of both classes every score is their mean, or 0.
    """
    model = fit(sample(docs, labels, "toxic"))

    def of(batch: pa.RecordBatch) -> dict:
        score = scores(utf8(batch), model)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}

    texts = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return arrow_map(texts, of, "doc_id bigint, held_out boolean, score double, predicted int")
