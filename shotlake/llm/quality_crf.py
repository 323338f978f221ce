"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad; its features are its own and its neighbours'.  The chain
learns from documents' labels (each line starts with its document's), and the
forward-backward marginals of the lines, weighted by their length, are a document's
score, calibrated on the same sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_or_empty, utf8
from .learning import logistic, held_out, sample, sigmoid
from .windows import chunks

THRESHOLD = 0.3
STEPS = 120
CHUNK = 1 << 19
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "sign": b"#*$%&<>^~=_\\", "bar": b"|", "cry": b"!", "digit": b"0123456789", "blank": b" \t\r\v\f", "stop": b".,;:?", "letter": bytes(range(97, 123)) + bytes(range(128, 256))}
_MEMBER = np.zeros((len(_CLASSES), 256), np.uint8)
for _i, _c in enumerate(_CLASSES.values()):
    _MEMBER[_i, list(_c)] = 1
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\"';:)")] = True


def lines_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, the lines' lengths, and the texts' bounds in lines."""
    joined = b"\n".join(data) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sizes = ends - starts
    text_ends = np.cumsum([len(x) + 1 for x in data])
    bounds = np.concatenate([[0], np.searchsorted(ends, text_ends - 1) + 1])
    counts = np.empty((len(_CLASSES), len(ends)))
    for i, member in enumerate(_MEMBER):
        sums = np.add.reduceat(member[raw], starts, dtype=np.int64)
        counts[i] = sums  # the line's end belongs to no class
    upper, sign, bar, cry, digit, blank, stop, letter = counts
    solid = np.maximum(sizes, 1)
    words = [x.split() for x in joined.split(b"\n")[:-1]]
    n = np.array([len(w) for w in words], float)
    variety = np.array([len(set(w)) for w in words], float) / np.maximum(n, 1)
    seen: set[tuple[int, int]] = set()
    again = np.zeros(len(ends))
    owner = np.repeat(np.arange(len(data)), np.diff(bounds))
    for i, (o, w) in enumerate(zip(owner.tolist(), words)):
        key = (o, hash(tuple(w)))
        again[i] = bool(w) and key in seen
        seen.add(key)
    last = raw[np.maximum(ends - 1, 0)]
    first_line, last_line = np.zeros(len(ends)), np.zeros(len(ends))
    first_line[bounds[:-1]] = 1
    last_line[bounds[1:] - 1] = 1
    total = np.repeat(np.add.reduceat(sizes, bounds[:-1]), np.diff(bounds))
    own = np.column_stack([
        np.log1p(sizes) / 5, upper / solid, np.minimum(sign / np.maximum(n, 1), 2), np.minimum(bar / np.maximum(n, 1), 1), np.minimum(cry / np.maximum(n, 1), 2),
        digit / solid, blank / solid, stop / np.maximum(n, 1), letter / solid, variety, np.log1p(n) / 5, n < 3, again, _ENDS[last] & (sizes > 0),
        np.minimum(sizes / np.maximum(n, 1) / 10, 2), sizes == 0,
    ])
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first_line > 0] = 0
    after[last_line > 0] = 0
    own = np.column_stack([own, first_line, last_line, np.log1p(total) / 10, total < 60, total < 250])
    return np.column_stack([own, before, after, np.ones(len(own))]), sizes.astype(float), bounds


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(scores: np.ndarray, bounds: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line the probability of each state, and the expected counts of each transition.

    All documents go forward and backward side by side, the longest first, so that
    step t takes those with more than t lines.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # documents with more than t lines
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[starts] = scores[starts]
    for t in range(1, longest):
        at = starts[: active[t]] + t
        alpha[at] = scores[at] + _log_sum(alpha[at - 1][:, :, None] + change, 1)
    expected = np.zeros((2, 2))
    whole = _log_sum(alpha[starts + sizes - 1], 1)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        after = change + (scores[at + 1] + beta[at + 1])[:, None, :]
        beta[at] = _log_sum(after, 2)
        expected += np.exp(alpha[at][:, :, None] + after - whole[: active[t + 1], None, None]).sum(axis=0)
    total = np.empty(len(sizes))
    total[order] = whole
    return np.exp(alpha + beta - np.repeat(total, np.diff(bounds))[:, None]), expected


def _pooled(good: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals, as log odds."""
    weight = sizes + 1
    p = np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(rows: list[tuple[str, int]]) -> dict:
    """Train on (text, label); without both classes every score is the same."""
    labels = np.array([y for _, y in rows], float)
    if len(set(labels.tolist())) < 2:
        return {"constant": float(labels.mean()) if len(labels) else 0.5}
    x, sizes, bounds = lines_of([t.encode() for t, _ in rows])
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[-1], spread[-1] = 0, 1
    spread[spread < 1e-6] = 1
    x = (x - mean) / spread
    of = np.repeat(labels.astype(int), np.diff(bounds))
    doc = np.repeat(np.arange(len(labels)), np.diff(bounds))
    # each document counts alike, its lines by length, and the classes alike
    weight = (sizes + 1) / np.bincount(doc, sizes + 1)[doc]
    weight *= (0.5 / np.bincount(labels.astype(int)))[of]
    observed = np.zeros((2, 2))
    inner = np.ones(len(of), bool)
    inner[bounds[1:] - 1] = False
    np.add.at(observed, (of[inner.nonzero()[0]], of[inner.nonzero()[0] + 1]), 1)
    target = np.eye(2)[of]
    w, change = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, change)]
    for step in range(1, STEPS + 1):
        p, expected = marginals(x @ w, bounds, change)
        slopes = (x.T @ (weight[:, None] * (p - target)) + 1e-4 * w, (expected - observed) / len(of) + 1e-3 * change)
        for value, slope, (m, v) in zip((w, change), slopes, state):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            value -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    pooled = _pooled(marginals(x @ w, bounds, change)[0][:, 1], sizes, bounds)
    a, b = logistic(pooled[:, None], labels, 1e-4)
    return {"mean": mean, "spread": spread, "w": w, "change": change, "a": a, "b": b}


def scores(data: list[bytes], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(data), model["constant"])
    out = []
    for piece in chunks([len(x) for x in data], CHUNK):
        x, sizes, bounds = lines_of(data[piece])
        p = marginals(((x - model["mean"]) / model["spread"]) @ model["w"], bounds, model["change"])[0]
        out.append(sigmoid(model["a"] * _pooled(p[:, 1], sizes, bounds) + model["b"]))
    return np.concatenate(out)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3).

    Null texts are scored as empty ones, repeated rows alike; an empty table gives an
    empty one.  Without labelled rows of both classes every score is their mean, or 0.5.
    """
    model = fit(sample(docs, labels, "quality"))

    def of(batch: pa.RecordBatch) -> dict:
        score = scores(utf8(batch), model)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)}

    texts = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return arrow_map(texts, of, "doc_id bigint, held_out boolean, score double, predicted int")
