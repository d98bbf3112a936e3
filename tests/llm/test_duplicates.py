import itertools
import random

import pytest

from ledgerloom.llm import jaccard, line_dedup
from ledgerloom.llm.components import components

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(3000)]


def text(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def edited(base, k):
    words = base.split()
    for _ in range(k):
        words[RNG.randrange(len(words))] = RNG.choice(VOCABULARY)
    return " ".join(words)


def brute_components(rows, k, num, den):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            low[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.fixture(scope="module")
def corpus():
    shared = text(30)  # a passage that very many hold
    base = text(120)
    rows = [text(60) for _ in range(20)]
    rows += [f"{shared} {text(RNG.randrange(5, 90))}" for _ in range(40)]
    rows += [edited(base, RNG.randrange(6)) for _ in range(60)]  # one large group of near copies
    rows += [edited(rows[i % 20], i % 4) for i in range(30)]
    rows += [rows[3]] * 10 + [rows[3].upper(), "one two", "ONE  two", "a b c d", "", None, " \n\t ", text(4000)]
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den", "small", "tile"), [(4, 85, 100, 6, 8), (5, 4, 5, 48, 2048)])
def test_components_match_brute_force(docs_of, corpus, k, num, den, small, tile):
    docs = docs_of([t for _, t in corpus])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs, k, num, den, small, tile).collect()}
    assert got == brute_components(corpus, k, num, den)


def test_repeated_and_null_ids(docs_of):
    a, b, c = text(90), text(80), text(85)
    rows = jaccard.near_duplicates(docs_of([a, a, b, a, None], [1, 1, 2, None, 3])).collect()
    assert sorted(((r["doc_id"] or -1, r["component_id"] or -1) for r in rows)) == [(-1, -1), (1, 1), (2, 2), (3, 3)]
    # An id with two texts has the links of both; its texts make one document, also of documents that only they join.
    rows = jaccard.near_duplicates(docs_of([a, b, a, b, c, c], [1, 1, 2, 3, 4, 5])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    rows = jaccard.near_duplicates(docs_of([edited(a, 1), b, a, edited(b, 1), edited(c, 1), c, c], [9, 9, 2, 3, 9, 1, 1])).collect()
    assert sorted({(r["doc_id"], r["component_id"]) for r in rows}) == [(1, 1), (2, 1), (3, 1), (9, 1)]


def test_empty_table(docs_of):
    assert jaccard.near_duplicates(docs_of(["x"]).where("false")).count() == 0


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 101), (100, 101), (None, 3), (7, None)], "a long, b long")
    assert {(r["node"], r["component"]) for r in components(edges).collect()} == {(i, 0) for i in range(51)} | {(100, 100), (101, 100)}


def is_patience(a, b, pairs):
    """The pairs are equal lines in order, and no gap between them holds what patience diff would still align."""
    assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(pairs))
    for (i, j), (k, m) in itertools.pairwise([(-1, -1), *pairs, (len(a), len(b))]):
        x, y = a[i + 1 : k], b[j + 1 : m]
        assert not (x and y) or x[0] != y[0] and x[-1] != y[-1]
        assert not {c for c in x if x.count(c) == 1} & {c for c in y if y.count(c) == 1}


def longest_increasing(values):
    best = []
    for i, v in enumerate(values):
        best.append(1 + max((best[j] for j in range(i) if values[j] < v), default=0))
    return max(best, default=0)


def test_patience():
    for _ in range(400):
        a, b = ([RNG.choice("abcdefghijkl"[: RNG.randrange(2, 12)]) for _ in range(RNG.randrange(14))] for _ in range(2))
        is_patience(a, b, line_dedup.patience(a, b))
        order = RNG.sample(range(9), 9)
        assert len(line_dedup.increasing(order)) == longest_increasing(order) and sorted(line_dedup.increasing(order)) == line_dedup.increasing(order)
        # Without repeats, head and tail apart, as many lines align as keep their order.
        assert len(line_dedup.patience([-1, *range(9), -2], [-3, *order, -4])) == longest_increasing(order)
    assert line_dedup.patience(list("axbyc"), list("abc")) == [(0, 0), (2, 1), (4, 2)]
    assert line_dedup.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])


def test_blocks_follow_each_other_in_both():
    assert line_dedup.blocks(list("abcde"), list("abxde"), [5] * 5, 10) == [(0, 1), (3, 4)]
    assert line_dedup.blocks(list("abcde"), list("axbcde"), [5] * 6, 10) == [(2, 5)]
    assert line_dedup.blocks(list("ab"), list("ab"), [4, 5], 10) == [] and line_dedup.blocks([], [], [], 1) == []
    assert line_dedup.smallest_blocks([b"a", b"b", b"c"], [12, 4, 6], 10) == [(b"a", 0, 0), (line_dedup.xxh3_128_digest(b"bc"), 1, 2)]


PASSAGE = [text(15), text(20), text(25)]
OWN = [text(12) for _ in range(12)]


def dedup(docs_of, texts, ids=None):
    rows = line_dedup.dedup_lines(docs_of(texts, ids))
    assert rows.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    return {r["doc_id"]: (r["text"], r["_ld_deleted"]) for r in rows.collect()}


def test_common_blocks_go_from_the_later_document(docs_of):
    texts = ["\n".join([OWN[0], *PASSAGE, OWN[1]]), "\n".join([OWN[2], "", *PASSAGE]), "\n".join([*PASSAGE[:2], OWN[3]]), OWN[4], None, "", "short\nline", "short\nother", "\n".join(PASSAGE)]
    got = dedup(docs_of, texts)
    assert got[0] == (texts[0], 0) and got[1] == (f"{OWN[2]}\n", 3) and got[2] == (OWN[3], 2)
    assert got[3][0] == OWN[4] and got[4] == (None, 0) and got[5] == ("", 0)
    assert got[6] == (texts[6], 0) and got[7] == (texts[7], 0)  # fewer words than a block must have
    assert got[8] == ("", 3)


def test_every_line_of_a_block_may_come_from_another_document(docs_of):
    """Every line is a block by itself, wherever it stands."""
    texts = [OWN[5], OWN[6], "\n".join([OWN[5], OWN[6]]), "\n".join([OWN[6], OWN[5]])]
    got = dedup(docs_of, texts)
    assert got[2] == ("", 2) and got[3] == ("", 2)


def test_very_common_line_and_copies(docs_of):
    line = text(14)
    texts = [f"{text(11)}\n{line}" for _ in range(60)] + ["\n".join(OWN[7:10])] * 30
    got = dedup(docs_of, texts)
    assert [i for i in range(60) if got[i][1] == 0] == [0] and all(got[i][1] == 1 for i in range(1, 60))
    assert [i for i in range(60, 90) if got[i][1] == 0] == [60] and got[89] == ("", 3)


def test_null_ids_and_rows_that_repeat(docs_of):
    rows = line_dedup.dedup_lines(docs_of([OWN[10], OWN[10], OWN[10], OWN[10]], [None, 1, 1, 2])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows) == [(0, OWN[10]), (1, OWN[10]), (1, OWN[10]), (2, "")]
    assert line_dedup.dedup_lines(docs_of(["x"]).where("false")).count() == 0


def brute_dedup(texts, rare, min_words=10):
    """The rules over all pairs of documents, without hashes or rounds of joins."""
    rows = [[(i, x.strip()) for i, x in enumerate(t.split("\n")) if x.strip()] for t in texts]
    own = [[x for _, x in r] for r in rows]
    words = [[len(x.split()) for x in r] for r in own]

    def smallest(d):
        for i in range(len(own[d])):
            for j in range(i, len(own[d])):
                if sum(words[d][i : j + 1]) >= min_words:
                    yield tuple(own[d][i : j + 1]), i, j
                    break

    first = [own.index(x) for x in own]
    held = {}
    for d in sorted(set(first)):
        for w, _, _ in smallest(d):
            held.setdefault(w, set()).add(d)
    ranges = lambda a, b: line_dedup.blocks(own[a], own[b], words[b], min_words)
    out = []
    for b, text_ in enumerate(texts):
        marks = [(0, len(own[b]) - 1)] if first[b] < b and any(smallest(b)) else []
        if first[b] == b:
            for a in range(b):
                if any(len(held[w]) <= rare and a in held[w] for w, _, _ in smallest(b)):
                    marks += ranges(a, b)
            stands = lambda: [(w, i, j) for w, i, j in smallest(b) if min(held[w]) < b and not any(x <= i and j <= y for x, y in marks)]  # noqa: B023, E731
            for a in {min(held[w]) for w, _, _ in stands()}:
                marks += ranges(a, b)
            marks += [(i, j) for _, i, j in stands()]
        gone = {k for x, y in marks for k in range(rows[b][x][0], rows[b][y][0] + 1)} if first[b] == b else set(range(len(text_.split("\n")))) if marks else set()
        out.append(("\n".join(x for k, x in enumerate(text_.split("\n")) if k not in gone), len(gone)))
    return out


@pytest.mark.parametrize("rare", [2, 4, 500])
def test_matches_every_pair(docs_of, rare):
    """Lines in any order and number, short ones and blank ones among them, held by a few documents or by most."""
    rng = random.Random(rare)
    hot, cold = [text(12) for _ in range(5)] + [text(3) for _ in range(6)] + ["", " "], [text(rng.randrange(3, 14)) for _ in range(150)]
    texts = ["\n".join(hot[:5]), "\n".join(hot[4::-1])] + ["\n".join([rng.choice(OWN), *rng.choices(hot, k=rng.randrange(2, 9)), *rng.choices(cold, k=rng.randrange(4)), text(11)]) for _ in range(110)]
    texts += [rng.choice(texts) for _ in range(10)] + ["\n".join(x for x in rng.choice(texts).split("\n") if rng.random() < 0.8) for _ in range(20)]
    rows = line_dedup.dedup_lines(docs_of(texts), rare=rare).collect()
    assert {r["doc_id"]: (r["text"], r["_ld_deleted"]) for r in rows} == dict(enumerate(brute_dedup(texts, rare)))


@pytest.mark.parametrize("holders", [2, 16, 17, 18])
def test_crossed_blocks_go_however_many_hold_them(docs_of, holders):
    """The last document holds the two lines in the other order, so that an alignment finds one of them only."""
    a, b = text(12), text(12)
    got = dedup(docs_of, [f"{a}\n{b}\n{text(11)}" for _ in range(holders - 1)] + [f"{b}\n{a}\n{OWN[3]}"])
    assert got[holders - 1] == (OWN[3], 2)


def test_no_block_is_stitched_from_several_documents(docs_of):
    """Neither line is a block, and no earlier document holds both."""
    a, b = text(5), text(6)
    got = dedup(docs_of, [f"{OWN[0]}\n{a}", f"{OWN[1]}\n{b}", f"{a}\n{b}", f"{a}\n{b}\n{OWN[2]}"])
    assert got[2] == (f"{a}\n{b}", 0) and got[3] == (OWN[2], 2)


def test_own_output_clashing_names_and_very_long_texts(docs_of):
    long = "\n".join(text(12) for _ in range(3000))
    docs = docs_of([long, f"{OWN[0]}\n{long}", "word " * 100_000, "word " * 100_000 + "\nend"])
    rows = line_dedup.dedup_lines(line_dedup.dedup_lines(docs.selectExpr("*", "1 as key", "2 as h", "3 as _ld_key")))
    got = {r["doc_id"]: (r["text"], r["_ld_deleted"]) for r in rows.collect()}
    assert got == {0: (long, 0), 1: (OWN[0], 0), 2: ("word " * 100_000, 0), 3: ("end", 0)}
    assert "key" in rows.columns and "_ld_key" not in rows.columns


def test_rows_that_repeat_align_all_their_lines(docs_of):
    """A text of several lines whose row repeats, as the earlier document and as the later one."""
    body, other = "\n".join(OWN[:6]), "\n".join(OWN[6:])
    got = line_dedup.dedup_lines(docs_of([body, body, body, other, other, other], [1, 1, 2, 3, 4, 4])).collect()
    assert sorted((r["doc_id"], r["text"], r["_ld_deleted"]) for r in got) == [(1, body, 0), (1, body, 0), (2, "", 6), (3, other, 0), (4, "", 6), (4, "", 6)]
