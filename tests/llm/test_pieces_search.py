import pickle
import random

import pytest

from ledgerloom.llm import impact_search, pieces
from pyspark.sql import functions as F

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(public.path("piece_bpe_32k.model"))


def whole_viterbi(text, model):
    """The whole lattice, kept to the end."""
    best, back = [0.0] + [float("-inf")] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - model.longest), end):
            found = model.ids.get(text[start:end])
            if found or start == end - 1:
                s = best[start] + (found[1] if found else model.penalty)
                if s > best[end]:
                    best[end], back[end] = s, start
    out, end = [], len(text)
    while end:
        piece = text[back[end] : end]
        out.append([model.ids[piece][0]] if piece in model.ids else [model.bytes_[b] for b in piece.encode()])
        end = back[end]
    return [i for ids in reversed(out) for i in ids]


TEXTS = ["", " ", "  two  spaces ", "Hello world, the quick brown fox.", "naïve café — ñandú\n\nline\tтекст 日本語 😀\x07", "a" * 3000, "ab" * 500 + "\n" * 40, "▁odd▁mark", "the" * 800, " \n \n", "x" + " " * 40 + "y", "supercalifragilistic" * 60]


def test_stream_equals_whole_lattice(model):
    rng = random.Random(1)
    made = ["".join(rng.choice("aeinrst ohl\n▁éß0.,") for _ in range(rng.randrange(400))) for _ in range(60)]
    for t in TEXTS + made:
        s = pieces.normalise(t, model)
        want = whole_viterbi(s, model)
        assert [i for ids in pieces.viterbi(s, model) for i in ids] == want, t[:40]
        assert pieces.encoded(t, model) == b"".join(i.to_bytes(4, "little", signed=True) for i in want), t[:40]


def test_lines_go_through_the_stream_whole(model, monkeypatch):
    """A search gets a whole line, as no piece holds a line end, and commits as it goes."""
    searched, search = [], pieces.search

    def counted(text, m):
        searched.append(text)
        yield from search(text, m)

    monkeypatch.setattr(pieces, "search", counted)
    text = "the quick brown fox the quick brown fox\n" + "naïve café " * 3
    assert pieces.encoded(text, model) == b"".join(i.to_bytes(4, "little") for i in whole_viterbi(pieces.normalise(text, model), model))
    assert searched == ["▁the▁quick▁brown▁fox▁the▁quick▁brown▁fox", "naïve▁café▁naïve▁café▁naïve▁café▁"]
    # Without a space, too, ids are committed where all paths meet.
    committed = list(pieces.viterbi("hello" * 2000, model))
    assert [i for ids in committed for i in ids] == whole_viterbi("hello" * 2000, model)
    assert len(committed) > 30 and max(map(len, committed)) < 300


def test_lines_of_the_given_table_are_committed_by_convergence(model):
    """Every attempt to commit on the driver's documents finds a meeting place, near the end of what was read, and the ids are those of the whole lattice."""
    import duckdb

    texts = [t or "" for (t,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()]
    step, early = pieces.WINDOWS * model.longest, 0
    for k, t in enumerate(texts):
        s = pieces.normalise(t, model)
        runs = [list(pieces.search(part, model)) for part in model.split.findall(s) if part[0] in model.known]
        parts = [part for part in model.split.findall(s) if part[0] in model.known]
        early += sum(len(r) - 1 for r in runs)
        assert all(len(r) == max(1, -(-len(p) // step)) for r, p in zip(runs, parts, strict=True))
        if k % 10 == 0:
            assert [i for ids in pieces.viterbi(s, model) for i in ids] == whole_viterbi(s, model)
    assert early > 200


def test_window_of_scores_is_bounded(model):
    text = "international" * 500
    assert max(len(x) for x in pieces.search(text, model)) <= 2 * pieces.WINDOWS * model.longest
    back = [(i << 3) + n for i, n in ((5, 1), (6, 2), (-1, 1), (7, 2))]  # boundaries 1 to 4, of which 3 and 4 may still be left; both go through 2
    assert pieces.meeting(back, 0, 4, 2, 3) == 2 and pieces.meeting([1] * 9, 0, 9, 3, 3) == 7


def varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def message(tag, body):
    return varint(tag << 3 | 2) + varint(len(body)) + body


def test_matches_the_library_with_the_same_pieces(model):
    """The public pieces with the operator's scores, put into a unigram model file that the library reads."""
    import struct

    import sentencepiece

    made = b"".join(message(1, message(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s / pieces.UNIT) + bytes([3 << 3, k])) for p, s, k in model.pieces)
    # unigram, with byte fallback; identity, a dummy prefix, and no white space removed
    made += message(2, bytes([3 << 3, 1]) + varint(35 << 3) + b"\1") + message(3, message(1, b"identity") + bytes([3 << 3, 1, 4 << 3, 0]))
    lib = sentencepiece.SentencePieceProcessor(model_proto=made)
    decoder = pieces.Decoder(model)
    for t in ["Hello world, the quick brown fox.", "In of the inanin. Thonst aonthrein", "naïve café ñandú", "日本語 text", "Des achlichä erberber das.", "two  spaces\n\nand 12,345.67 \x07 lines"]:
        ids = pieces.encoded(t, model)
        got = [int.from_bytes(ids[k : k + 4], "little", signed=True) for k in range(0, len(ids), 4)]
        assert got == lib.encode(t)
        assert decoder.decode(ids) == lib.decode(got) == t


def test_round_trip_and_edges(docs_of, model):
    texts = [None, *TEXTS[:5], TEXTS[5]]
    rows = {r["doc_id"]: r for r in pieces.digests(docs_of(texts), model).collect()}
    assert rows[0]["n_ids"] == 0 and all(r["exact"] for i, r in rows.items())
    ids = {r["doc_id"]: r for r in pieces.encode(docs_of(texts), model, ["doc_id"]).collect()}
    assert ids[0]["ids"] is None and ids[1]["ids"] == [] and ids[4]["n_ids"] == rows[4]["n_ids"]
    assert pieces.digests(docs_of(texts).where("false"), model).count() == 0


def brute_top(rows, queries, k):
    out = []
    for q in queries:
        for i, v in rows:
            if i == q:
                scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in rows if j != q))[:k]
                out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard", [7, 64, 10_000])
def test_top_k_matches_brute_force(spark, shard):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(16)]) for i in range(230)]
    rows += [(i, rows[5][1]) for i in range(230, 300)]  # many ties
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1))
    got = impact_search.top_k(table, F.col("vec_id") % 100 == 0, 10, shard_rows=shard)
    import numpy as np

    whole = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute_top(whole, [0, 100, 200], 10)


def test_segments_fall_in_impact_and_stop_on_proof():
    import numpy as np

    rng = np.random.default_rng(2)
    matrix = np.floor(rng.standard_normal((3000, 24)) * 100)
    index = impact_search.Index(np.arange(3000), matrix)
    sizes = [set(np.abs(impact).tolist()) for _, _, impact in index.segments]
    assert all(len(s) == 1 for s in sizes) and [max(s) for s in sizes] == sorted((max(s) for s in sizes), reverse=True)
    seen = np.zeros_like(matrix)
    for (rows, dims, impact), rest in zip(index.segments, index.rest, strict=True):
        seen[rows, dims] += impact
        assert np.abs(matrix - seen).max() <= 2 / 3 * np.abs(impact[0]) and np.allclose(rest, np.sqrt(((matrix - seen) ** 2).sum(1)))
    assert (seen == matrix).all()
    for q in range(20):
        ids, scores = index.search(q, matrix[q], 10)
        whole = matrix @ matrix[q]
        want = [j for j in np.lexsort((np.arange(3000), -whole)) if j != q][:10]
        assert ids.tolist() == want and scores.tolist() == whole[want].tolist()


def test_search_stops_before_half_of_the_postings_of_the_given_table():
    import numpy as np
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pydict()
    matrix, ids = np.floor(1024 * np.array(rows["embedding"], float)), np.array(rows["vec_id"])
    index = impact_search.Index(ids, matrix)
    asked = [i for i, q in enumerate(ids) if q % 100 == 0]
    for i in asked:
        index.search(int(ids[i]), matrix[i], 10)
    assert index.used < 0.5 * len(asked) * sum(len(r) for r, _, _ in index.segments) and index.rescored < 0.25 * len(asked) * len(ids)


def test_repeated_ids_give_one_result_however_they_are_dealt(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])]
    want = [(0, 1, 3, 512 * 2048), (0, 2, 1, 512 * 1024), (0, 3, 2, 512 * 1024), (0, 4, 2, 512 * 1024)]
    for parts in (1, 3, 6):
        table = spark.createDataFrame(rows[::-1] if parts == 3 else rows, "vec_id long, embedding array<double>").repartition(parts)
        for shard in (1, 2, 100):
            assert sorted(map(tuple, impact_search.top_k(table, F.col("vec_id") == 0, 10, shard_rows=shard).collect())) == want


def test_top_k_edges(spark):
    big = 3e5
    rows = [(0, [1.0, 2.0]), (100, None), (200, [float("nan"), 1.0]), (300, [None, 1.0]), (1, [big, big]), (2, [1.0]), (3, [float("inf")]), (4, []), (None, [1.0, 1.0]), (5, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = impact_search.top_k(table, F.col("vec_id") % 100 == 0, 10).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 3 * int(big) * 1024 * 1024), (0, 2, 1 << 20), (0, 4, 0), (0, 5, -(1 << 20))]
    assert impact_search.top_k(table.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_automaton_is_completed_as_it_is_used_and_kept_small(model):
    fresh = pieces.Model(model.pieces, model.dummy_prefix, model.trim)
    assert len(fresh.start) == 0 and pickle.loads(pickle.dumps(fresh)) is pickle.loads(pickle.dumps(fresh))
    text = "".join(sorted(c for c in model.known if c != "▁")) * 2 + " the international the "
    state, ends = fresh.start, {}
    for end, c in enumerate(pieces.normalise(text, fresh), 1):
        state, begin, _, code, others = state[c]
        ends[end] = [-begin, *(-b for b, _, _ in others)]
        assert code & ((1 << fresh.bits) - 1) == -begin and sum(n not in state.children for n in state) <= pieces.KEPT
    known = fresh.ids.keys() | fresh.joined
    said = pieces.normalise(text, fresh)
    assert all(ends[e] == [n for n in range(min(e, fresh.longest), 0, -1) if said[e - n : e] in known] for e in ends)
