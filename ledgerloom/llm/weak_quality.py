"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over the counts of
vote patterns (of all documents; at most 3 to the number of labellers rows) estimates how each labeller votes in
each class and so a posterior for each pattern. The posteriors of a bounded sample of documents (``train_docs``, those
with the smallest hashes of their id) train a linear scorer on hashed features: shapes of words, and how words and lines repeat. It sees
no votes, so what it knows it has learnt from the posteriors; it scores every document.

Defined cases: null or empty text gets abstentions, no shapes, and is rejected; null ids are scored and keep their null
id; repeated rows are each scored; whole texts are read; extra columns stay where the input's columns are returned; an empty
table gives an empty result. With no document to train on, everything is kept.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, texts
from ledgerloom.llm.linear import Rows, feature_hash, fit, sigmoid

BITS = 14
# The labellers.
LABELLERS = ("symbols", "capitals", "bars", "exclamations", "duplicate_lines", "variety", "stutter", "redundancy", "letters")


def _counts(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER = _counts(b"#*$%&|<>"), _counts(bytes(range(65, 91)))
_LETTER, _SPACE = _counts(bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)])), _counts(b" \t\n\x0b\x0c\r")
_START = np.array([b & 0xC0 != 0x80 for b in range(256)])
# Shapes: a small letter (or any beyond ASCII), A capital, 0 digit, the rest as they are.
_SHAPE = np.frombuffer(bytes(65 if 65 <= b <= 90 else 97 if b >= 128 or 97 <= b <= 122 else 48 if 48 <= b <= 57 else b for b in range(256)), np.uint8)


def vote(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def votes(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(LABELLERS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    symbols, upper, letters, chars = (int(counts[t].sum()) for t in (_SYMBOL, _UPPER, _LETTER, _START & ~_SPACE))
    lines = [x for x in text.split(b"\n") if x.strip()]
    stutter, packed = sum(map(bytes.__eq__, words, words[1:])), len(zlib.compress(text, 1))
    dup, bars, distinct, exclaim = len(lines) - len(set(lines)), words.count(b"|"), len(set(words)), int(counts[33])
    return (
        vote(symbols * 10 > n, False),
        vote(10 * upper > 4 * letters and letters > 20, False),
        vote(10 * bars > n, False),
        vote(10 * exclaim > n, False),
        vote(2 * dup > len(lines), False),
        vote(n >= 50 and distinct < 2 * n**0.5, 2 * distinct > n),
        vote(n >= 20 and 5 * stutter > n, False),
        vote(n >= 50 and 5 * packed < len(text), n >= 50 and 4 * packed > len(text)),
        vote(n >= 20 and 4 * letters < 3 * chars, 10 * letters > 8 * chars and 5 * upper < letters),
    )


def shapes(text: bytes) -> tuple[list[int], list[float]]:
    """Hashed shapes of words and the square root of their share."""
    data = _SHAPE[np.frombuffer(text, np.uint8)]
    if not len(data):
        return [], []
    keep = np.ones(len(data), bool)
    keep[1:] = data[1:] != data[:-1]
    found = Counter(data[keep].tobytes().split())
    total, out = sum(found.values()), Counter()
    for shape, k in found.items():
        out[feature_hash(shape, BITS)] += k / total
    ids = sorted(out)
    return ids, [out[i] ** 0.5 for i in ids]


def features(text: bytes) -> tuple[list[int], list[float]]:
    """Hashed shapes, and the shares of words and lines by how often they occur (in powers of two) and of words that follow themselves; square roots."""
    ids, values = shapes(text)
    out = Counter(dict(zip(ids, values, strict=True)))
    words, shares = text.split(), Counter()
    if words:
        for k, n in Counter(Counter(words).values()).items():
            shares[b"w%d" % min(12, (k - 1).bit_length())] += k * n / len(words)
        lines = [x for x in text.split(b"\n") if x.strip()]
        for k, n in Counter(Counter(lines).values()).items():
            shares[b"l%d" % min(8, (k - 1).bit_length())] += k * n / len(lines)
        shares[b"next"] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    for name, share in shares.items():
        out[feature_hash(b"#" + name, BITS)] += share**0.5
    ids = sorted(out)
    return ids, [out[i] for i in ids]


def em(patterns: dict[tuple[int, ...], int], rounds: int = 60, objective: list[float] | None = None) -> dict[tuple[int, ...], float]:
    """Posterior of the good class for each vote pattern, by expectation-maximisation of a mixture of two classes in which votes are independent.

    In each class a labeller votes bad, abstains or votes good with rates that sum to 1, each counted once more than seen (a Dirichlet prior of 2), as is each class. So what an abstention says is estimated like any other
    vote: much where a labeller always finds its fault, little where it seldom does. What is maximised is the log likelihood plus that of the prior; it never falls, and is appended to ``objective`` round by round. It starts from
    trusting a vote against a document more than votes for it.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    v, n = np.array(keys) + 1, np.array([patterns[k] for k in keys], float)
    good = sigmoid(2.0 - 4.0 * (v == 0).sum(1))
    for _ in range(rounds):
        logs, prior = [], 0.0
        for w in (n * (1 - good), n * good):
            rates = np.array([[w[v[:, j] == x].sum() + 1 for x in range(3)] for j in range(v.shape[1])])
            rates /= rates.sum(1, keepdims=True)
            share = (w.sum() + 1) / (n.sum() + 2)
            prior += np.log(rates).sum() + np.log(share)
            logs.append(np.log(share) + sum(np.log(rates[j][v[:, j]]) for j in range(v.shape[1])))
        if objective is not None:
            objective.append(float((n * np.logaddexp(*logs)).sum() + prior))
        good = sigmoid(logs[1] - logs[0])
    return {k: float(p) for k, p in zip(keys, good, strict=True)}


def vote_patterns(docs: DataFrame) -> dict[tuple[int, ...], int]:
    """Counts of vote patterns over all documents."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Counter(votes(t or b"") for t in texts(batch.column(0)))
        return pa.RecordBatch.from_arrays([pa.array([",".join(map(str, k)) for k in found]), pa.array(list(found.values()), pa.int64())], ["votes", "n"])

    rows = arrow_map(docs.select("text"), f, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    return {tuple(map(int, r[0].split(","))): r[1] for r in rows}


def train(docs: DataFrame, train_docs: int = 8000) -> tuple[np.ndarray, float] | None:
    """Weights and bias of the scorer."""
    posterior = em(vote_patterns(docs))
    ids = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(train_docs)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [t or b"" for t in texts(batch.column(1))]
        x = [features(t) for t in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array([i for i, _ in x], pa.list_(pa.int32())), pa.array([v for _, v in x], pa.list_(pa.float64())), pa.array([list(votes(t)) for t in found], pa.list_(pa.int32()))],
            ["doc_id", "ids", "values", "votes"])

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most train_docs numbers
    got = sorted(tuple(r) for r in arrow_map(rows, f, "doc_id long, ids array<int>, values array<double>, votes array<int>").collect())
    got = [r for i, r in enumerate(got) if not i or r[0] != got[i - 1][0]]
    if not got:
        return None
    x = Rows([np.array(r[1], np.int64) for r in got], [np.array(r[2], float) for r in got], 1 << BITS)
    y = np.array([posterior.get(tuple(r[3]), 0.5) for r in got])
    w, v = fit(x, np.zeros((len(got), 0)), y, l2=1e-4, steps=150)
    return w, float(v[-1])


def score(docs: DataFrame, weights: tuple[np.ndarray, float] | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, quality (probability of the good class), kept."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        quality = decide(texts(batch.column(1)), weights)
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(quality), pa.array(quality >= threshold)], ["doc_id", "quality", "kept"])

    return arrow_map(docs.select("doc_id", "text"), f, "doc_id long, quality double, kept boolean")


def decide(found: list[bytes | None], weights: tuple[np.ndarray, float] | None) -> np.ndarray:
    empty = np.array([not (t or b"").strip() for t in found], bool)
    if weights is None:
        return np.where(empty, 0.0, 1.0)
    x = [features(t or b"") for t in found]
    rows = Rows([np.array(i, np.int64) for i, _ in x], [np.array(v, float) for _, v in x], 1 << BITS)
    return np.where(empty, 0.0, sigmoid(rows.dot(weights[0]) + weights[1]))


def keep_good(docs: DataFrame, weights: tuple[np.ndarray, float] | None, threshold: float = 0.5) -> DataFrame:
    """Rows of docs that the scorer keeps, with all their columns, in one pass and without a join."""
    place = docs.columns.index("text")

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(decide(texts(batch.column(place)), weights) >= threshold))

    return arrow_map(docs, f, docs.schema)
