"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import regex

sha = lambda b: hashlib.sha256(b).hexdigest()
words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")


def suffix(docs, length=400):
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def substring(docs, size=50):
    big = 1 << 63
    data = [(i, words(t)) for i, t in docs]
    first = {}
    for i, w in data:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, w in data:
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (big if i is None else i):
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return out


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def near(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < k)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(sets[k]), least.get(top(k))) for k, (i, _) in enumerate(docs)]


def rules(text):
    t = text or ""
    w = words(t)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    inside = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), failed


def cleaned(text, phrases):
    """What the line rules leave of a text, and whether the document is kept."""
    t = text or ""
    size = lambda x: sum(map(len, words(x)))
    left = []
    for x in dict.fromkeys(y for y in t.split("\n") if words(y)):
        bars, signs, n = x.count("|"), len(re.findall(r"[#*$%&|<>!]", x)), size(x)
        navigation = bars >= 3 or (bars and n < 80)
        boilerplate = n < 200 and any(p in x.lower() for p in phrases)
        shouting = n >= 20 and not regex.search(r"\p{Ll}", x) and regex.search(r"\p{Lu}", x)
        bare = n < 20 and not re.search("[.!?:;\"'»”)]$", x.rstrip(" "))
        if not (navigation or boilerplate or signs * 20 > n or shouting or bare):
            left.append(x)
    lost = 1 - sum(map(size, left)) / size(t) if size(t) else 0
    return "\n".join(left), not rules(t)[-1] and lost <= 0.5


def distance(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def marginals(scores, change):
    """Probabilities of the states of a chain, and expected transitions, from all its paths."""
    n, k = scores.shape
    paths = list(itertools.product(range(k), repeat=n))
    weight = np.exp([sum(scores[t, s] for t, s in enumerate(p)) + sum(change[a, b] for a, b in zip(p, p[1:])) for p in paths])
    weight /= weight.sum()
    states, moves = np.zeros((n, k)), np.zeros((k, k))
    for p, w in zip(paths, weight):
        for t, s in enumerate(p):
            states[t, s] += w
        for a, b in zip(p, p[1:]):
            moves[a, b] += w
    return states, moves


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def pii(text):
    def holds(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            d = [int(c) for c in digits[::-1]]
            return 16 <= len(d) <= 19 and sum(d[::2] + [x * 2 - 9 if x > 4 else x * 2 for x in d[1::2]]) % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15

    found = {k: [m.span() for m in re.finditer(p, text or "") if holds(k, m[0])] for k, p in KINDS.items()}
    joined = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])
    return (*[len(found[k]) for k in KINDS], joined)


def generalised(text, spans):
    """The text with its spans (as joined) in brackets; those that overlap go as one, under the first one's kind."""
    out, reach = [], 0
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in spans.split(",") if x)):
        if a >= reach:
            out += [text[reach:a], f"[{kind.upper()}]"]
        reach = max(reach, b)
    return "".join(out) + text[reach:]


def bits(value):
    """Information content: the length times the entropy of the characters."""
    n = len(value)
    return -sum(c * math.log2(c / n) for c in Counter(value).values())
