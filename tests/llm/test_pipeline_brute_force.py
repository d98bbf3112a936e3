"""Every stage of the pipeline against plain Python over all documents and pairs, each on what its predecessor kept."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_components, brute_dedup
from test_pieces_search import whole_viterbi

import corpus_pipeline
from ledgerloom.llm import common, mixing, pieces, weak_quality
from ledgerloom.llm.linear import Rows, fit

RNG = random.Random(29)
FIRST, LAST = ("lo", "mi", "tra", "ven", "sul", "por", "ha"), ("ra", "ne", "dil", "kos", "tum", "ing")
WORDS = [a + b for a in FIRST for b in LAST] + [a + b + c for a in FIRST for b in FIRST for c in LAST]


def plain_em(counts, rounds=60):
    """Expectation-maximisation document class by document class, written out."""
    good = {k: 1 / (1 + math.exp(4.0 * k.count(-1) - 2.0)) for k in counts}
    for _ in range(rounds):
        logs = {}
        for name, weight in (("bad", {k: n * (1 - good[k]) for k, n in counts.items()}), ("good", {k: n * good[k] for k, n in counts.items()})):
            total = sum(weight.values())
            rate = [{x: (1 + sum(w for k, w in weight.items() if k[j] == x)) / (total + 3) for x in (-1, 0, 1)} for j in range(len(next(iter(counts))))]
            logs[name] = {k: math.log(total + 1) + sum(math.log(rate[j][x]) for j, x in enumerate(k)) for k in counts}
        good = {k: 1 / (1 + math.exp(min(700, logs["bad"][k] - logs["good"][k]))) for k in counts}
    return good


def line(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n)).capitalize() + "."


def edited(text, k):
    """Words changed far apart, each line touched, so that few blocks stay common."""
    lines = [x.split() for x in text.split("\n")]
    for i, x in enumerate(lines):
        for _ in range(k if i else 1):
            x[RNG.randrange(len(x))] = RNG.choice(WORDS)
    return "\n".join(map(" ".join, lines))


@pytest.fixture(scope="module")
def corpus():
    own = ["\n".join(line(RNG.randrange(20, 90)) for _ in range(RNG.randrange(2, 6))) for _ in range(90)]
    passage, hot = "\n".join(line(25) for _ in range(3)), line(30)
    texts = own + [f"{t}\n{passage}" for t in own[:12]] + [f"{line(60)}\n{hot}\n{line(40)}" for _ in range(40)]
    base = line(400)
    texts += [edited(base, 1) for _ in range(8)] + [edited(own[i], i % 3) for i in range(20, 50)] + [own[7]] * 5
    texts += [" ".join(["spam eggs"] * 60), line(80).upper().replace(" ", "!! "), " | ".join(line(80).split()), " ".join(w + "&&&" for w in line(80).split())] * 6
    texts += [None, "", " \n ", "a few words", "\n".join(line(60) for _ in range(120))]
    RNG.shuffle(texts)
    return [(i, t, ("en", "de", "fr", "es", None)[i % 5], f"src{i % 7}", len(t or "")) for i, t in enumerate(texts)]


def good(rows):
    """Ids that a scorer keeps which is fitted without Spark."""
    found = [(t or "").encode() for _, t in rows]
    posterior = plain_em(Counter(map(weak_quality.votes, found)))
    x = [weak_quality.features(t) for t in found]
    sparse = Rows([np.array(i, np.int64) for i, _ in x], [np.array(v, float) for _, v in x], 1 << weak_quality.BITS)
    w, v = fit(sparse, np.zeros((len(found), 0)), np.array([posterior[weak_quality.votes(t)] for t in found]), l2=1e-4, steps=150)
    return {i for (i, t), s in zip(rows, sparse.dot(w) + v[-1], strict=True) if s >= 0 and (t or "").strip()}


def mixed(docs):
    """Ids, once an epoch, by ordering each leaf and epoch whole."""
    place = lambda e: F.pmod(F.xxhash64(F.xxhash64("doc_id", "text"), F.lit(e), F.lit(1)), F.lit(1 << 40)).alias(f"k{e}")
    names = [F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")).alias(f"l{n}") for n, x in enumerate(corpus_pipeline.levels())]
    rows = [(tuple(r[:3]), r["doc_id"], len(r["text"].encode().split()), r["k0"], r["k1"]) for r in docs.select(*names, "doc_id", "text", place(0), place(1)).collect()]
    leaves = {}
    for leaf, *row in rows:
        leaves.setdefault(leaf, []).append(row)
    sizes = {leaf: sum(n for _, n, *_ in x) for leaf, x in leaves.items()}
    budgets = mixing.leaf_budgets({leaf: 2.0 * n for leaf, n in sizes.items()}, corpus_pipeline.WEIGHTS, float(sum(sizes.values())))
    out = []
    for leaf, x in leaves.items():
        left = int(budgets[leaf] + 1e-6)
        for e in range(2):
            room, total = min(left, sizes[leaf]), 0
            left -= room
            for r in sorted(x, key=lambda r: r[2 + e]):  # noqa: B023
                total += r[1]
                if total > room:
                    break
                out.append(r[0])
    return sorted(out)


def test_each_stage_equals_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(common.stored(stage(spark, kept[-1], ""), "stage"))
    text_of = [{r["doc_id"]: r["text"] for r in d.collect()} for d in kept[:4]]

    assert set(text_of[1]) == good([(i, t) for i, t, *_ in corpus]) and len(text_of[0]) - 35 < len(text_of[1]) < len(text_of[0])

    ids = sorted(text_of[1])
    lines = zip(ids, brute_dedup([text_of[1][i] for i in ids], 16), strict=True)
    assert text_of[2] == {i: t for i, (t, n) in lines if not n or t.strip()} and len(text_of[2]) < len(text_of[1])

    components = brute_components(sorted(text_of[2].items()), 5, 4, 5)
    assert set(text_of[3]) == {i for i, (_, c) in components.items() if c == i} and len(text_of[3]) < len(text_of[2])
    assert all(text_of[3][i] == text_of[2][i] for i in text_of[3])

    selected = sorted(r["doc_id"] for r in kept[4].collect())
    assert selected == mixed(kept[3]) and len(set(selected)) < len(selected)

    model = pieces.load_model(corpus_pipeline.tokenizer_path())
    want = {i: whole_viterbi(pieces.normalise(t, model), model) for i, t in text_of[3].items()}
    rows = kept[5].collect()
    assert sorted(r["doc_id"] for r in rows) == selected and all(r["ids"] == want[r["doc_id"]] and r["n_ids"] == len(r["ids"]) for r in rows)
