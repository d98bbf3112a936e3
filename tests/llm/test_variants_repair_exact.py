import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__
from ledgerloom.llm import conversations, exact_dedup, spelling

# --- exact dedup ---


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_groups(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    best = {k: min(v) for k, v in groups.items()}
    return Counter((rows[i][0], rows[best[k][3]][0], len(v), i == best[k][3], hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for *_, i in v)


LONG = "lorem ipsum " * 30_000


def test_exact_groups_match_brute_force(spark, docs_of):
    texts = ["a b", "ab", "a  b", None, "", " \n\t", "é x", "éx", "ab", "x" * 70 + "1", "x" * 70 + "2", LONG, LONG + " ", "b a", " ab", *["copy of many"] * 40, *["c o p y ofmany"] * 3]
    ids = [5, 4, 9, 3, 2, 1, 7, 8, 4, *range(20, 20 + len(texts) - 9)]
    ids[-1], ids[-2] = None, None
    rows = list(zip(ids, texts, strict=True))
    got = exact_dedup.exact_groups(docs_of(texts, ids), digest_all=True).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in got) == brute_groups(rows)


def test_refinement_hashes_only_what_is_open(docs_of):
    texts = ["one", "three", "same start " * 20 + "a", "same start " * 20 + "b", "alone and long enough to differ", "same length as x", "same length as y"]
    rows = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs_of(texts)).collect()}
    assert [i for i, r in rows.items() if r["digest"] is not None] == [2, 3] and all(r["kept"] and r["group_size"] == 1 for r in rows.values())


def test_deduplicate_keeps_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "k"), (2, "a  b", 8, "l"), (2, "a  b", 8, "l"), (3, None, 9, "m")], "doc_id long, text string, group_size int, kept string")
    assert sorted(map(tuple, exact_dedup.deduplicate(docs).collect()), key=str) == [(2, "a  b", 8, "l"), (3, None, 9, "m")]
    assert exact_dedup.deduplicate(docs.where("false")).count() == 0 and exact_dedup.exact_groups(docs.where("false")).count() == 0


# --- spelling variants ---


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: best[w] if w in best and n[best[w]] >= 2 * n[w] else None for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def as_rows(df):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


@pytest.mark.parametrize("common", [1, 4, 64])
def test_variants_match_brute_force(spark, common):
    r = random.Random(3)
    words = {"".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(500)} | {"prefix" + c for c in "abcdefghij"} | {"prefix" + c + d for c in "abc" for d in "xy"} | {"aaaaa", "aaaaaa", "x" * 3000, "x" * 3001}
    n = {w: int(3 * 2 ** (6 * r.random())) for w in sorted(words)}
    got = as_rows(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), common=common))
    assert len(got) == len(set(got)) and set(got) == brute_variants(n)


def test_counting_and_forms_match_brute_force(spark, docs_of):
    r = random.Random(5)
    known = ["letter", "better", "bitter", "ÉTUDE", "étude", "straße", "abc", "under_score", "naïve", "x1yzabc"]
    texts = [" ".join(r.choice(known) for _ in range(60)) for _ in range(150)] + [None, "", "  \n", "Wort" * 20_000]
    ids = [*range(len(texts) - 1), None]
    got = as_rows(spelling.variants(spelling.word_counts(docs_of(texts, ids), spelling.one_letter_lost)))
    assert len(got) == len(set(got)) and set(got) == brute_variants(brute_words(zip(ids, texts, strict=True)))
    assert spelling.variants(spelling.word_counts(docs_of(["x"]).where("false"))).count() == 0


# --- conversations ---


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edits in the order of cost and then of letters, until one gives the pattern: (cost, edits, repaired rows)."""
    faults, todo = faults_of(rows), [(0, "", 0, "", ())]
    while True:
        cost, edits, i, roles, kept = heapq.heappop(todo)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, edits, kept
        ways = [(5, "I", i, role, "") for role in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            ways.append((2, "D", i + 1, None, ""))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                ways += [*([(more, "K", i + 1, role, text)] if role else []), *((more + 1, "R", i + 1, new, text) for new in ("user", "assistant"))]
        for add, letter, j, role, text in ways:
            now = roles + (role[:1] if role is not None else "")
            if re.fullmatch("s?(ua)*u?", now) and cost + add <= 2 * len(rows):
                heapq.heappush(todo, (cost + add, edits + letter, j, now, kept if role is None else (*kept, (role, text))))


def expected(rows):
    """rows: (turn, role, text) of a conversation, damaged already."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    turns, faults = [t for t, _, _ in rows if t is not None], faults_of([r[1:] for r in rows])
    cost, edits, kept = cheapest([r[1:] for r in rows])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256(text.encode()).hexdigest()


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, piece int, audit string"


def some_conversations(n, longest=7):
    r = random.Random(11)
    say = ["Hello.", "No stop", "Why?", "", " \n", "Ünï ende!", "ok.\u0085", "a:b\nc."]
    return [(c, r.choice([None, t, t, t, t + 5]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User"]), r.choice(say) + r.choice(["", f" {r.random()}."])) for c in range(n) for t in range(r.randint(0, longest))]


def test_audits_match_search_over_all_edits(spark):
    rows = some_conversations(80)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in conversations.audits(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)).collect()}
    want = {c: expected([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def damage(conv_id, turn, role, text):
    say = lambda x: " " if x is None else x
    k = zlib.crc32(f"{say(conv_id)}:{say(turn)}".encode()) % 20
    row = (turn, "user" if k == 4 else say(role), "" if k == 1 else re.sub("[.!?]", "", say(text)) if k == 2 else say(text))
    return [row] * {0: 0, 3: 2}.get(k, 1)


def test_damage_nulls_and_conversations_without_rows(spark):
    rows = [(*r[:2], r[2] or None, r[3] or None) for r in some_conversations(60, 4)] + [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    rows += [(c, 0, "user", "Hi.") for c in range(1000, 1060)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in conversations.audits(conversations.damaged(df), df).collect()}
    assert got == {c: expected([x for r in rows if r[0] == c for x in damage(*r)]) for c in {r[0] for r in rows}}
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values()
    assert conversations.audits(df.where("false")).count() == 0


def test_a_conversation_of_many_pieces_equals_sql_and_comes_out_in_pattern(spark, tmp_path):
    """3,000 rows are some twelve pieces; SQL goes row by row, without any."""
    r = random.Random(2)
    rows = [(7, t, r.choice(["system", "user", "assistant", "tool"]), r.choice(["same.", "", f"text {t}", f"text {t}!"])) for t in range(3000)] + [(8, 1, "user", "x" * 300_000 + "."), (8, 2, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    base = duckdb.connect()
    base.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = base.sql(__spark_entry__.oracle_sql()["op12_conversation_repair"])
    got = __spark_entry__.queries()["op12_conversation_repair"](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    out = conversations.repaired(df).orderBy("conv_id", "position").collect()
    for c in (7, 8):
        assert re.fullmatch("(s?(ua)+)?", "".join(x["role"][0] for x in out if x["conv_id"] == c))
    assert [x["position"] for x in out if x["conv_id"] == 7] == list(range(sum(x["conv_id"] == 7 for x in out)))


def test_trie_holds_one_branch_and_shares_prefixes(monkeypatch):
    steps, step = [], conversations.next_layer
    monkeypatch.setattr(conversations, "next_layer", lambda layer, sign: steps.append(sign) or step(layer, sign))
    signs = sorted(["ua", "uaua", "uauu", "s", "x", "xu"])
    found = dict(conversations.trie_answers(iter(signs)))
    assert len(steps) == 1 + 2 + 2 + 1 + 2  # s; u a; u a and u u without the first two; x; u
    for s in signs:
        layer = conversations.first_layer()
        for sign in s:
            layer = step(layer, sign)
        assert layer == found[s] and conversations.unpacked(conversations.packed(layer)) == layer
