import functools
import math
import operator
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ledgerloom.llm import common, toxicity, weak_quality
from ledgerloom.llm.linear import Rows, fit, sigmoid

RNG = random.Random(11)
WORDS = [a + b for a in ("lo", "mi", "tra", "ven", "sul", "por", "ha") for b in ("ra", "ne", "dil", "kos", "tum", "ing")]
TOXIC = ["idiot", "moron", "worthless", "pathetic"]


def prose(n, extra=()):
    words = [RNG.choice(WORDS) for _ in range(n)]
    for w in extra:
        words[RNG.randrange(n)] = w
    return " ".join(words).capitalize() + "."


def test_linear_fit():
    rng = np.random.default_rng(1)
    x = [np.flatnonzero(rng.random(20) < 0.3) for _ in range(400)]
    y = np.array([float(3 in i or 7 in i) for i in x])
    rows = Rows(x, None, 20)
    w, v = fit(rows, np.zeros((400, 0)), y)
    assert ((sigmoid(rows.dot(w) + v[-1]) > 0.5) == y).mean() > 0.97
    part = rows.take(np.arange(10, 30))
    assert np.allclose(part.dot(w), rows.dot(w)[10:30])


def test_toxicity_on_held_out_documents(spark, docs_of):
    texts = [prose(60, RNG.sample(TOXIC, RNG.randrange(1, 4)) if i % 3 == 0 else ()) for i in range(600)] + [None, "", "x" * 200_000]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(0, 0), (0, 1), (9999, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    assert chain.categories == ("kind_1", "kind_2", "toxic")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, chain).collect()}
    assert len(got) == len(texts) and sum(got[i] == (i % 3 == 0) for i in range(400, 600)) / 200 > 0.97
    assert not got[600] and not got[601] and not got[602]
    empty = toxicity.train(docs, labels.where("false"))
    assert all(r["p_toxic"] < 1e-6 for r in toxicity.score(docs, empty).collect())
    assert toxicity.score(docs.where("false"), chain).count() == 0


def plain_fit(x, extra, y, steps=100):
    """Adam on log loss over rows that are dicts, one weight at a time."""
    width = 1 + (len(extra[0]) if extra else 0)
    extra = [[*e, 1.0] for e in extra]
    w = {f: [0.0, 0.0, 0.0] for r in x for f in r}
    v = [[0.0, 0.0, 0.0] for _ in range(width)]
    for t in range(1, steps + 1):
        grad, dense = {f: 1e-3 * w[f][0] for f in w}, [0.0] * width
        for r, e, label in zip(x, extra, y, strict=True):
            z = sum(w[f][0] for f in r) + sum(a * c[0] for a, c in zip(e, v, strict=True))
            d = (1 / (1 + math.exp(-max(-40, min(40, z)))) - label) / len(x)
            for f in r:
                grad[f] += d
            for i, a in enumerate(e):
                dense[i] += d * a
        for cell, d in [*((w[f], grad[f]) for f in w), *zip(v, dense, strict=True)]:
            cell[1], cell[2] = 0.9 * cell[1] + 0.1 * d, 0.99 * cell[2] + 0.01 * d * d
            cell[0] -= 0.3 * (1 - t / (steps + 1)) * (cell[1] / (1 - 0.9**t)) / (math.sqrt(cell[2] / (1 - 0.99**t)) + 1e-9)
    return {f: c[0] for f, c in w.items()}, [c[0] for c in v]


def plain_chosen(rows, y, most):
    """Features of four documents or more whose rates differ by 3.5 standard errors, by id, with their scores."""
    n, p = len(rows), sum(y)
    there, hit = Counter(f for r in rows for f in r), Counter(f for r, label in zip(rows, y, strict=True) if label for f in r)
    scores = {f: (hit[f] / max(1, p) - (c - hit[f]) / max(1, n - p)) / math.sqrt(max(c / n * (1 - c / n), 1e-12) * (1 / max(1, p) + 1 / max(1, n - p))) for f, c in there.items() if c >= 4}
    best = sorted((f for f, z in scores.items() if abs(z) >= 3.5), key=lambda f: (-abs(scores[f]), f))[:most]
    return {f: scores[f] for f in sorted(best)}


def plain_kinds(rows, y, scores, kinds):
    """Which kinds each document is of: k-means on the documents that hold a feature, by cosine."""
    marks, members = [f for f, z in scores.items() if z > 0], [i for i, label in enumerate(y) if label]
    out = [[0] * kinds for _ in rows]
    if not marks or not members:
        return out
    unit = []
    for f in marks:
        v = [float(f in rows[i]) for i in members]
        unit.append([a / math.sqrt(sum(v)) if sum(v) else 0.0 for a in v])
    dot = lambda a, b: sum(map(operator.mul, a, b))
    centres = [unit[max(range(len(marks)), key=lambda j: scores[marks[j]])]]
    while len(centres) < kinds:
        centres.append(unit[min(range(len(marks)), key=lambda j: max(dot(unit[j], c) for c in centres))])
    group = []
    for _ in range(20):
        group = [max(range(kinds), key=lambda k, u=u: dot(u, centres[k])) for u in unit]
        for k in range(kinds):
            if k in group:
                centres[k] = [sum(a) for a in zip(*(u for u, g in zip(unit, group, strict=True) if g == k), strict=True)]
            size = math.sqrt(dot(centres[k], centres[k]))
            centres[k] = [a / max(size, 1e-9) for a in centres[k]]
    for i in members:
        held = [sum(f in rows[i] for f, g in zip(marks, group, strict=True) if g == k) for k in range(kinds)]
        out[i] = [int(h == max(held) and h > 0) for h in held]
    return out


def plain_chain(rows, y, fold, kinds, most):
    """The chain by direct recursion: a chain of the first ``many`` links on the documents of some folds, with all that it learns from made without the fold that it is used for."""
    every = frozenset(range(4))
    whole = plain_kinds(rows, y, plain_chosen(rows, y, most), kinds)

    def train(inside, many):
        at = [i for i in range(len(rows)) if fold[i] in inside]
        scores = plain_chosen([rows[i] for i in at], [y[i] for i in at], most)
        found = plain_kinds([rows[i] for i in at], [y[i] for i in at], scores, kinds)
        pairs = sorted(((-sum(found[j][a] * whole[i][b] for j, i in enumerate(at)), a, b) for a in range(kinds) for b in range(kinds)))
        name = {}
        for _, a, b in pairs:
            if a not in name.values() and b not in name:
                name[b] = a
        labels = [[*(found[j][name[b]] for b in range(kinds)), y[i]] for j, i in enumerate(at)]
        chain = []
        for k in range(many):
            earlier = [use(train(inside - {fold[i]}, k), rows[i]) for i in at] if k else [[] for _ in at]
            chain.append(plain_fit([[f for f in rows[i] if f in scores] for i in at], earlier, [label[k] for label in labels]))
        return chain

    train = functools.cache(train)
    return train(every, kinds + 1)


def use(chain, row):
    out = []
    for w, v in chain:
        z = sum(w.get(f, 0.0) for f in row) + sum(a * b for a, b in zip(out, v, strict=False)) + v[-1]
        out.append(1 / (1 + math.exp(-max(-40, min(40, z)))))
    return out


def plain_features(text):
    words = {w.encode() for w in re.split("[^a-z0-9]+", text.lower()) if w}
    named = {b"w" + w for w in words} | {b"p%d" % k + w[:k] for w in words for k in range(3, 8) if len(w) >= k}
    return sorted({xxhash.xxh3_64_intdigest(f) % (1 << 20) for f in named})


def test_training_equals_plain_python(spark, docs_of):
    """Sample, folds, features, kinds and links against plain Python that shares nothing with the operator but the folds' hash."""
    r, texts = random.Random(5), []
    for i in range(140):
        words = [r.choice(WORDS) for _ in range(25)]
        if i % 3 == 0:
            words += r.sample(TOXIC[:2] if i % 2 else TOXIC[2:], r.choice((1, 2))) + r.sample(TOXIC, r.choice((0, 0, 1)))
        texts.append(" ".join(words))
    docs, toxic = docs_of(texts), [int(i % 3 == 0) for i in range(140)]
    chain = toxicity.train(docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"), most=40)
    fold = [x[0] for x in spark.range(140).selectExpr("cast(pmod(xxhash64(id, 23), 4) as int)").collect()]
    rows = list(map(plain_features, texts))
    want = plain_chain(rows, toxic, fold, 2, 40)
    got = {x["doc_id"]: x for x in toxicity.score(docs, chain).collect()}
    for i, row in enumerate(rows):
        assert [got[i]["p_kind_1"], got[i]["p_kind_2"], got[i]["p_toxic"]] == pytest.approx(use(want, row), abs=1e-6)
    assert len({got[i]["p_kind_1"] > 0.5 for i in range(140)}) == 2


def test_sets_of_folds_and_few_documents(spark, docs_of):
    assert len(toxicity.subsets(4, 2)) == 11 and len(toxicity.subsets(3, 0)) == 1
    docs = docs_of(["an idiot", "lora mine", None])
    chain = toxicity.train(docs, spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int"))
    assert toxicity.score(docs, chain).count() == 3
    alone = toxicity.train(docs, spark.createDataFrame([(0, 1)], "doc_id long, toxic int"), kinds=0)
    assert alone.categories == ("toxic",)
    with pytest.raises(ValueError, match="folds"):
        toxicity.train(docs, docs, kinds=4)


def test_kinds_are_found_in_the_data():
    ids = [np.array([1, 2, 3]) if i % 4 == 1 else np.array([2, 3]) if i % 4 == 2 else np.array([7, 8]) if i % 4 == 3 else np.array([50]) for i in range(80)]
    toxic = np.array([int(i % 4 > 0) for i in range(80)])
    kinds = toxicity.kinds_of(Rows(ids, None, 60), toxic, np.array([1, 2, 3, 7, 8, 50]), np.array([5.0, 6, 7, 6, 6, -9]), 2)
    assert [tuple(k) for k in kinds[:4]] == [(0, 0), (1, 0), (1, 0), (0, 1)]
    assert toxicity.kinds_of(Rows([], None, 0), np.array([]), np.array([], int), np.array([]), 2).shape == (0, 2)
    assert toxicity.named_alike(kinds[:, ::-1], kinds).tolist() == kinds.tolist()


def junk(i):
    return [" ".join(w + "&&&" for w in prose(80).split()), prose(80).upper().replace(" ", "!! "), " | ".join(prose(80).split()), " ".join(["spam eggs"] * 60)][i % 4]


def test_quality_by_weak_labels(docs_of):
    texts = [junk(i) if i % 4 == 0 else prose(80) + "\n" + prose(40) + "\n" + prose(30) for i in range(400)] + [None, "", "  "]
    docs = docs_of(texts)
    weights = weak_quality.train(docs)
    got = {r["doc_id"]: r["kept"] for r in weak_quality.score(docs, weights).collect()}
    assert sum(got[i] == (i % 4 != 0) for i in range(400)) / 400 > 0.97 and not any(got[i] for i in (400, 401, 402))
    kept = weak_quality.keep_good(docs, weights)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k} and kept.columns == docs.columns
    assert weak_quality.train(docs.where("false")) is None


def test_em_finds_who_is_right():
    rng = random.Random(2)
    counts = {}
    truth = {}
    for _ in range(5000):
        good = rng.random() < 0.8
        v = tuple((-1 if not good and rng.random() < 0.6 or rng.random() < 0.01 else 1 if good and k < 2 and rng.random() < 0.7 else 0) for k in range(4))
        counts[v] = counts.get(v, 0) + 1
        truth.setdefault(v, []).append(good)
    posterior = weak_quality.em(counts)
    right = sum((posterior[v] > 0.5) == g for v, gs in truth.items() for g in gs)
    assert right / 5000 > 0.93 and weak_quality.em({}) == {}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    passage = "\n".join(prose(30) for _ in range(2))
    texts = [junk(i) if i % 10 == 0 else prose(70) + "\n" + prose(50) + (f"\n{passage}" if i % 7 == 1 else "") for i in range(120)]
    texts += [texts[11]] * 3 + [texts[12].replace(".", " the.", 1)] * 2
    rows = [(i, t, "en", f"src{i % 5}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return str(d), texts, passage


def test_pipeline_stage_by_stage(spark, folder):
    path, texts, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources", "SentencePiece encoding"]
    names = list(steps)
    a = steps[names[0]](spark, docs, path)
    assert a.columns == list(corpus_pipeline.COLUMNS) and {r["doc_id"] for r in a.collect()} == {i for i in range(len(texts)) if i % 10 or i >= 120}
    b = steps[names[1]](spark, a, path)
    rows = {r["doc_id"]: r for r in b.collect()}
    assert b.columns == list(corpus_pipeline.COLUMNS) and sum(passage in r["text"] for r in rows.values()) == 1 and 120 not in rows
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    c = steps[names[2]](spark, b, path)
    assert {r["doc_id"] for r in c.collect()} <= set(rows)
    d = steps[names[3]](spark, c, path)
    assert d.columns == list(corpus_pipeline.COLUMNS) and d.count() > 0
    e = steps[names[4]](spark, d, path)
    assert e.count() == d.count() and all(r["n_ids"] == len(r["ids"]) > 0 for r in e.collect())


def test_pipeline_runs_whole(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.count() > 0 and "ids" in out.columns


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null, blank and very long texts, repeated rows and ids, null ids, clashing columns, and an empty table."""
    good = [prose(70) + "\n" + prose(60) for _ in range(30)]
    long = "\n".join(prose(40) for _ in range(300))
    rows = [(i, t, "en", f"src{i % 3}", len(t), "x", 1) for i, t in enumerate(good)]
    rows += [(100, None, "en", "src0", None, "x", 1), (101, "", None, None, 0, "x", 1), (102, " \n\t", "en", "src1", 3, "x", 1), (103, long, "en", "src1", len(long), "x", 1), (None, good[3] + "\n" + prose(50), "en", "src2", 1, "x", 1)]
    rows += [(0, good[0], "en", "src0", len(good[0]), "y", 2), (104, good[5], "de", "src9", len(good[5]), "y", 2), (5, good[6], "en", "src0", len(good[6]), "y", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _ld_key string, _mix_cut int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, str(tmp_path)), "stage")
        kept.append([r["doc_id"] for r in docs.collect()])
        assert name == "SentencePiece encoding" or docs.columns == list(corpus_pipeline.COLUMNS)
    assert not {100, 101, 102} & set(kept[0]) and {103, None, *range(30)} <= set(kept[0])
    assert 104 not in kept[1] and kept[2].count(0) == 2 and kept[2].count(None) == 1 and set(range(30)) - {5, 6} <= set(kept[2])
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_em_never_falls_and_equals_plain_python():
    from test_pipeline_brute_force import plain_em

    r = random.Random(8)
    for share in (0.1, 0.5, 0.8):
        counts = Counter()
        for _ in range(3000):
            bad = r.random() < share
            counts[tuple(-1 if bad and r.random() < 0.3 else 0 for _ in range(4)) + tuple((r.choice([-1, 0]) if bad else r.choice([0, 1, 1])) if r.random() < 0.9 else 0 for _ in range(3))] += 1
        seen = []
        got, want = weak_quality.em(dict(counts), objective=seen), plain_em(counts)
        assert all(b >= a - 1e-6 for a, b in zip(seen, seen[1:], strict=False)) and max(abs(got[k] - want[k]) for k in counts) < 1e-6


def test_junk_of_any_share_is_told_apart():
    """Votes on the driver's labelled documents, with as many good ones drawn, again and again, as make junk a tenth to four fifths of all."""
    base = duckdb.connect()
    found = base.sql("select text, quality from '/root/testdata/sf0.01/documents.parquet' join '/root/testdata/sf0.01/labels.parquet' using (doc_id)").fetchall()
    bad, good = ([weak_quality.votes((t or "").encode()) for t, q in found if q == k] for k in (0, 1))
    r = random.Random(4)
    for share in (0.1, 0.3, 0.6, 0.8):
        more = [r.choice(good) for _ in range(int(20 * len(bad) * (1 - share) / share))]
        posterior = weak_quality.em(dict(Counter(bad * 20 + more)))
        assert sum(posterior[v] < 0.5 for v in bad) / len(bad) > 0.95 and sum(posterior[v] > 0.5 for v in more) / len(more) > 0.97, share
