import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import archives, common, mixing


def test_arc_versions_and_lengths():
    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhello\n\nfiledesc://no 1 2 3 4\n"
    records = [archives.Record({"url": "http://a/?q=1", "ip": "1.2.3.4", "date": "20010203040506", "type": "text/html"}, body), archives.Record({"url": "dns:a", "ip": "0.0.0.0", "date": "2001", "type": "text/dns"}, b"")]
    for version in archives.ARC_FIELDS:
        got = list(archives.parse_arc(archives.arc_bytes(records, version)))
        assert [r.body for r in got] == [body, b""] and [r.fields["url"] for r in got] == ["http://a/?q=1", "dns:a"]
        warc = [archives.to_warc(r) for r in got]
        assert [w.kind for w in warc] == ["response", "resource"] and warc[0].fields["WARC-Date"] == "2001-02-03T04:05:06Z"
        assert warc[0].fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body.split(b"\r\n\r\n", 1)[1]).hexdigest()
        data = b"".join(archives.warc_bytes(w) + b"\r\n\r\n" for w in warc)
        assert [(r.kind, r.body) for r in archives.parse_warc(data)] == [("response", body), ("resource", b"")]


def test_legacy_files_as_a_table(spark, tmp_path):
    """Plain, as one gzip member, and with a member for each record."""
    records = [archives.page_arc(str(i), f"http://a/{i}", b"<p>%d</p>" % i * 40) for i in range(5)] + [archives.Record({"url": "dns:a", "ip": "0.0.0.0", "date": "2001", "type": "text/dns"}, b"")]
    whole = archives.arc_bytes(records, 2)
    head, _, _ = whole.partition(b"http://a/0")
    members, rest = [gzip.compress(head)], whole[len(head) :]
    for r in records:
        at = rest.index(r.body, rest.index(b"\n") + 1) + len(r.body) + 1
        members.append(gzip.compress(rest[:at]))
        rest = rest[at:]
    for name, data in (("a.arc", whole), ("b.arc.gz", gzip.compress(whole)), ("c.arc.gz", b"".join(members))):
        (tmp_path / name).write_bytes(data)
        rows = {r["url"]: r for r in archives.read_arc(spark, str(tmp_path), name).collect()}
        assert len(rows) == 6 and rows["dns:a"]["record_type"] == "resource" and rows["dns:a"]["date"] == "2001-01-01T00:00:00Z"
        assert rows["http://a/3"]["record_type"] == "response" and rows["http://a/3"]["payload_digest"] == "sha256:" + hashlib.sha256(b"<p>3</p>" * 40).hexdigest()
    with pytest.raises(archives.ArchiveError):
        archives.inflated(gzip.compress(whole)[:-20])


@pytest.mark.parametrize("data", [b"http://a 1 2 t 9\nabc\n", b"http://a 1\n", b"no end", b"filedesc://x 0 0 t 4\n7 0 \nhttp://a 1 2 t 0\n\n"])
def test_broken_archives(data):
    with pytest.raises(archives.ArchiveError):
        list(archives.parse_arc(data))


def test_pages_round_trip(spark):
    long, odd = "é" * 60, "a\r\n\r\nWARC/1.1\r\n\r\n" * 10
    rows = [(3, "http://x/ü z", long), (1, None, long), (7, "u", long), (2, "", None), (4, "v", ""), (5, "w", "short"), (6, "w", "short"), (8, "y", odd), (9, "y", odd + "b"), (None, "n", long), (10, "big", "z" * 300_000), (11, "big", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("x"))
    got = {r["page_id"]: r for r in archives.round_trip(pages).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        data = (html or "").encode()
        assert got[i]["payload_bytes"] == len(data) and got[i]["payload_digest"] == hashlib.sha256(data).hexdigest() and got[i]["url"] == (url or "")
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items() if r["record_type"] == "revisit"} == {3: ("revisit", 1), 7: ("revisit", 1), 11: ("revisit", 10), None: ("revisit", 1)}
    assert archives.round_trip(pages.where("false")).count() == 0


def test_budgets_pass_to_siblings_before_ancestors():
    capacity = {("a", "x", "1"): 10.0, ("a", "x", "2"): 100.0, ("a", "y", "3"): 100.0, ("b", "x", "4"): 1000.0}
    weights = {("a",): 1.0, ("b",): 1.0, ("a", "x"): 1.0, ("a", "y"): 1.0, ("a", "x", "1"): 1.0, ("a", "x", "2"): 1.0}
    got = mixing.leaf_budgets(capacity, weights, 200)
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 40, ("a", "y", "3"): 50, ("b", "x", "4"): 100}  # sibling 2 takes what 1 cannot
    got = mixing.leaf_budgets(capacity, weights, 600)
    assert got[("a", "x", "1")] == 10 and got[("a", "x", "2")] == 100 and got[("a", "y", "3")] == 100 and got[("b", "x", "4")] == 390
    assert sum(mixing.leaf_budgets(capacity, weights, 9999).values()) == 1210
    assert mixing.leaf_budgets({}, {}, 5) == {} and mixing.leaf_budgets(capacity, weights | {("b",): 0.0}, 100)[("b", "x", "4")] == 0
    with pytest.raises(ValueError, match="negative"):
        mixing.leaf_budgets(capacity, {("a",): -1.0}, 1)


def test_weights_by_pattern():
    capacity = {(d, x): 100.0 for d in "ab" for x in ("en", "de", "fr")}
    weights = {("*",): 1.0, ("*", "en"): 3.0, ("*", "*"): 1.0, ("b", "de"): 0.0}
    got = mixing.leaf_budgets(capacity, weights, 100)
    assert got == {("a", "en"): 30, ("a", "de"): 10, ("a", "fr"): 10, ("b", "en"): 37.5, ("b", "de"): 0, ("b", "fr"): 12.5}
    assert mixing.leaf_budgets(capacity, {("b", "*"): 0.0}, 100)[("a", "en")] == pytest.approx(100 / 3)


def test_prefix_of_each_leaf_matches_sorting_it(docs_of):
    texts = ["w " * (1 + i % 7) for i in range(200)] + [None, ""]
    docs = docs_of(texts)
    rows = mixing.mix(docs, ["lang", "source"], {("en", "src0"): 4.0, ("en", "src1"): 1.0, ("en", "src2"): 1.0}, 0.9, 3, seed=7)
    got = sorted((r["_mix_leaf"], r["_mix_epoch"], r["doc_id"]) for r in rows.collect())
    key = lambda e: docs.select("doc_id", F.pmod(F.xxhash64(F.xxhash64("doc_id", "text"), F.lit(e), F.lit(7)), F.lit(1 << 40)).alias("k"))
    order = {e: {r["doc_id"]: r["k"] for r in key(e).collect()} for e in range(3)}
    sizes = {f"src{s}": {i: 1 + i % 7 for i in range(200) if i % 3 == s} for s in range(3)}
    capacity = {("en", s): 3.0 * sum(x.values()) for s, x in sizes.items()}
    budgets = mixing.leaf_budgets(capacity, {("en", "src0"): 4.0, ("en", "src1"): 1.0, ("en", "src2"): 1.0}, 0.9 * sum(sum(x.values()) for x in sizes.values()))
    want = []
    for (_, s), b in budgets.items():
        left = int(b + 1e-6)
        for e in range(3):
            room, total = min(left, sum(sizes[s].values())), 0
            left -= room
            for i in sorted(sizes[s], key=lambda i: order[e][i]):
                total += sizes[s][i]
                if total > room:
                    break
                want.append((f"en/{s}", e, i))
    assert got == sorted(want)


def test_mix_edges(docs_of):
    assert mixing.mix(docs_of(["a b", "c"]).where("false"), ["lang"], {}).count() == 0
    rows = mixing.mix(docs_of(["a b", "c", "d"], [None, 1, 1]), ["lang", F.lit(None).cast("string")], {}, 1.0, 1)
    assert rows.count() == 3 and rows.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "component", "n"]
    assert mixing.mix(docs_of(["a", "b"]), ["lang"], {("en",): 0.0}).count() == 0


def test_mix_null_and_repeated_ids(docs_of):
    # Null and repeated ids are ordered by their texts, and each text is as likely to be chosen as any other.
    docs = docs_of([f"a b{i}" for i in range(400)], [None] * 200 + [7] * 200)
    rows = mixing.mix(docs, ["lang"], {}, 0.5, 1).collect()
    assert len(rows) == 200 and 60 < sum(r["doc_id"] is None for r in rows) < 140
    # Rows that repeat id and text are selected together or not at all.
    docs = docs_of(["same words"] * 30 + [f"x{i} y" for i in range(70)], [1] * 30 + list(range(100, 170)))
    for share in (0.3, 0.6, 0.9):
        rows = mixing.mix(docs, ["lang"], {}, share, 1).collect()
        assert sum(r["doc_id"] == 1 for r in rows) in (0, 30) and len(rows) <= share * 100
    big = docs_of(["w " * 300_000, "a b", "c d"])
    assert {r["doc_id"] for r in mixing.mix(big, ["lang"], {}, 1.0, 1).collect()} == {0, 1, 2}
    again = mixing.mix(mixing.mix(big.withColumn("_mix_cut", F.lit(1)), ["lang"], {}), ["lang"], {}, 1.0, 1)
    assert again.count() == 3 and again.columns.count("_mix_leaf") == 1 and "_mix_cut" not in again.columns


def test_shared_folder(spark):
    rows = common.stored(spark.range(5), "test")
    kept = common.stored(spark.range(3), "test")
    assert rows.count() == 5
    common.release(spark, kept)
    assert kept.count() == 3 and not os.path.exists(rows.stored_at.removeprefix("file://"))
    common.drop(kept)
    assert not os.path.exists(kept.stored_at.removeprefix("file://"))


def test_word_count(spark):
    for text in ("", " ", "a", " a", "a ", "a b", "\ta\x0bb\x0cc\rd\ne ", "a\u00a0b \u2003", "\x1fa"):
        row = spark.createDataFrame([(text,)], "t string").select(common.word_count("t").alias("n"), common.has_words("t").alias("h")).first()
        assert (row["n"], row["h"]) == (len(text.encode().split()), bool(text.encode().split())), repr(text)
    assert spark.sql("select cast(null as string) as t").select(common.word_count("t")).first()[0] == 0
