"""Scans in two levels: files over many tasks, records over many splits, numbers that stay the same."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import disjoint, in_range_list
from ledgerloom.operators import issues, mapping, statements
from ledgerloom.sources import ExtractError, lines_of, read_csv, state
from ledgerloom.sources.state import State


@pytest.fixture
def split_small(spark):
    """Files are cut every 64 bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def python_rows(path):
    with open(path, newline="", encoding="utf-8") as f:
        return [{k: (v or "").strip() for k, v in row.items()} for row in csv.DictReader(f)]


def spark_rows(spark, path):
    rows = read_csv(spark, str(path)).orderBy("_seq").drop("_seq")
    return [r.asDict() for r in rows.collect()]


CASES = {
    "plain": "A,B,C\n1,2,3\n4,5\n\n6,,7\n",
    "no end": "A,B\n1,2\n3,4",
    "line ends": 'A,B\r\n1,"x\r\ny"\r\n2,"a\n\nb"\r\n3,z\r\n',
    "lone returns": 'A,B\r1,"p\rq"\r2,r\r',
    "quotes": 'A,B\n"say ""hi""",5" pipe\n"a"b,"c" d\n"""",""\n',
    "header": '"A\nx","B,y"\n1,2\n"3\n3",4\n',
    "header again": "A,B\n1,2\nA,B\n3,4\n",
    "spaces": "A,B\n  \n 1 , 2 \n",
    "twice": "A,A,B\n1,2,3\n",
    "only a header": "A,B\n",
    "unicode": 'É,B\n"ü\n–", x \n',
}


@pytest.mark.parametrize("name", CASES)
def test_csv_equals_pythons(spark, tmp_path, name):
    (tmp_path / "x.csv").write_bytes(CASES[name].encode())
    assert spark_rows(spark, tmp_path / "x.csv") == python_rows(tmp_path / "x.csv")


@pytest.mark.parametrize("seed", range(4))
def test_records_over_many_splits_equal_pythons(spark, tmp_path, split_small, seed):
    r = random.Random(seed)
    field = lambda: r.choice(["", "a", 'q""q', "x,y", "two\nlines", "crlf\r\nhere", "long " * 40, "\n" * 5, '""', "5' pipe"])
    text = "A,B,C\r\n" + "".join(",".join(f'"{f}"' if set(f) & set('",\r\n') else f for f in (field() for _ in range(3))) + r.choice(["\n", "\r\n"]) for _ in range(120))
    (tmp_path / "x.csv").write_bytes(text.encode())
    assert read_csv(spark, str(tmp_path / "x.csv")).select("_seq.block").distinct().count() > 10
    assert spark_rows(spark, tmp_path / "x.csv") == python_rows(tmp_path / "x.csv")


def test_many_files_have_a_header_each_and_an_empty_one_is_an_error(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f'A,B\n{i},"x\ny"\n')
    assert [r["A"] for r in spark_rows(spark, tmp_path)] == ["0", "1", "2"]
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ExtractError):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_a_plain_file_is_not_shuffled(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CASES["plain"])
    assert "Exchange" not in read_csv(spark, str(tmp_path / "x.csv"))._jdf.queryExecution().executedPlan().toString()


# --- statements ---


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
def test_blocks_of_any_size_give_the_same_statements(spark, block):
    r = random.Random(1)
    words = ["LOOP AT t.", "ENDLOOP.", "x = 1", "* note.", "", "y = 2.", "z", "w.", "  v"]
    texts = [(str(i) if i else None, "\n".join(r.choice(words) for _ in range(r.randrange(40)))) for i in range(30)] + [("open", "a\nb\nc\nd\ne"), ("one", "\n\n\na.")]
    lines = lines_of(spark.createDataFrame(texts, "path string, text string"))
    rows = statements.with_depth(statements.statements(lines, block_lines=block)).collect()
    want = []
    for path, text in texts:
        no, part, first, depth = 0, [], 0, 0
        for n, line in [*enumerate(text.splitlines(), 1), (0, None)]:
            code = "" if line is None or line.strip().startswith("*") else line.strip()
            if code:
                first = first or n
                part.append(code)
            if part and (line is None or code.endswith(".")):
                said = " ".join(part)
                depth = max(0, depth - 1) if said.startswith("ENDLOOP") else depth
                want.append((path, no, first, said, depth))
                depth += said.startswith("LOOP")
                no, part, first = no + 1, [], 0
    assert sorted(((r["path"], r["stmt_no"], r["line"], r["text"], r["loop_depth"]) for r in rows), key=str) == sorted(want, key=str)


def test_a_file_of_a_million_lines_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    n = 10**6
    lines = spark.range(0, n, 1, 8).select(F.lit("big").alias("path"), (F.col("id") + 1).cast("int").alias("line"), F.when(F.col("id") % 4 == 0, "LOOP AT t.").when(F.col("id") % 4 == 1, "x = 1").when(F.col("id") % 4 == 2, "+ 2.").otherwise("ENDLOOP.").alias("text"))
    rows = statements.with_depth(statements.statements(lines)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("loop_depth").alias("depth"), F.max("stmt_no").alias("last")).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["n"] for r in rows) == 3 * n // 4 and sum(r["depth"] for r in rows) == n // 4 and max(r["last"] for r in rows) == 3 * n // 4 - 1
    assert len(rows) == 4 and max(r["n"] for r in rows) < n // 2


# --- numbering ---


def test_numbers_stay_the_same_when_blocks_are_lost(spark):
    """Everything that was held is dropped, and the rows are dealt differently, between planning and reading."""
    rows = spark.range(5000).select(F.struct((F.col("id") * 7919 % 5000).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("b")).alias("k"))
    out = mapping.numbered(rows, "k", 1, "n", 16)
    first = sorted((r["k"]["a"], r["n"]) for r in out.collect())
    spark.catalog.clearCache()
    for _, rdd in list(spark.sparkContext._jsc.getPersistentRDDs().items()):
        rdd.unpersist(True)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = sorted((r["k"]["a"], r["n"]) for r in out.repartition(3).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert first == again == [(i, i + 1) for i in range(5000)]


def test_numbering_of_few_rows_and_none(spark):
    one = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert sorted(map(tuple, mapping.numbered(one, "k", 10, "n", 50).collect())) == [("a", 10), ("b", 11), ("c", 12)]
    assert mapping.numbered(one.where("false"), "k", 1, "n").count() == 0
    many = spark.createDataFrame([(1,)] * 40 + [(2,)] * 40, "k int")
    assert sorted(r["n"] for r in mapping.numbered(many, "k", 1, "n", 8).collect()) == list(range(1, 81))


# --- groups ---


def test_a_giant_group_is_joined_in_chunks(spark):
    """A third of the rows share a description, which is null for others; keys come in input order."""
    rows = spark.range(0, 60_000, 1, 6).select(((F.col("id") * 7919) % 60_000).alias("_seq"), F.concat(F.lit("k"), (F.col("id") * 7919) % 60_000).alias("k"), F.when(F.col("id") % 3 == 0, "same").when(F.col("id") < 4, None).when(F.col("id") < 100, F.lit("few")).otherwise(F.col("id").cast("string")).alias("d"))
    found = issues.duplicates(rows, "o", "R", [F.col("d"), F.lit(1)], "k", "d", lambda c: F.coalesce(c, F.lit("none")))
    want = {}
    for i in range(60_000):
        d = "same" if i % 3 == 0 else "none" if i < 4 else "few" if i < 100 else str(i)
        want.setdefault(d, []).append(i * 7919 % 60_000)
    got = {r["message"]: (r["key"], r["_seq"]) for r in found.collect()}
    assert got == {d: (", ".join(f"k{i}" for i in sorted(v)), min(v)) for d, v in want.items() if len(v) > 1}
    assert issues.duplicates(rows.where("false"), "o", "R", [F.col("d")], "k", "d", lambda c: c).count() == 0


# --- state and range lists ---


def test_an_update_rewrites_what_it_touches_and_can_be_repeated(spark, tmp_path, monkeypatch):
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("v"), F.lit("old").alias("t"))
    kept = State.create(rows, str(tmp_path / "s"), ["k"], 8)
    changes = spark.createDataFrame([(5, 2, "b"), (5, 1, "a"), (500, 1, "new")], "k long, v int, t string")
    want = {(i, 0, "old") for i in range(100) if i != 5} | {(5, 2, "b"), (500, 1, "new")}
    with monkeypatch.context() as m:
        m.setattr(state, "move", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.upsert(changes, F.col("v"))
    assert kept.version() == 1 and {tuple(r) for r in kept.read().collect()} == {(i, 0, "old") for i in range(100)}
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("*.parquet")}
    touched = kept.upsert(changes, F.col("v"))
    assert len(touched) <= 2 and {tuple(r) for r in kept.read().collect()} == want and all(f.stat().st_mtime_ns == t for f, t in before.items())
    assert kept.upsert(changes, F.col("v")) == touched and {tuple(r) for r in State(spark, str(tmp_path / "s")).read().collect()} == want
    assert {tuple(r) for r in kept.read(1).collect()} == {(i, 0, "old") for i in range(100)} and kept.upsert(changes.where("false"), F.col("v")) == [] and kept.version() == 3
    kept.vacuum()
    assert kept.versions() == [3] and kept.read().count() == 101
    with pytest.raises(ValueError, match="state already"):
        State.create(rows, str(tmp_path / "s"), ["k"])


def test_long_range_lists_equal_their_predicate(spark):
    r = random.Random(9)
    entries = [(r.choice("IIE"), "EQ", r.randrange(-50, 3000), None) if r.random() < 0.4 else (r.choice("IIIE"), "BT", a := r.randrange(-50, 3000), a + r.choice([-2, 0, 1, 5, 300])) for _ in range(120)]
    rows = spark.range(-60, 3400).select("id", F.when(F.col("id") % 50 != 0, F.col("id")).alias("v"))
    for some in (entries, [e for e in entries if e[0] == "E"], [e for e in entries if e[1] == "EQ"], []):
        got = [x["id"] for x in in_range_list(rows, "v", spark.createDataFrame(some, "sign string, option string, low long, high long")).orderBy("id").collect()]
        inside = lambda v, sign: any(v == low if option == "EQ" else low <= v <= high for s, option, low, high in some if s == sign)  # noqa: B023, E731
        has = any(e[0] == "I" for e in some)
        assert got == [i for i in range(-60, 3400) if (not has if i % 50 == 0 else (not has or inside(i, "I")) and not inside(i, "E"))]
    plan = in_range_list(rows, "v", spark.createDataFrame(entries, "sign string, option string, low long, high long"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    parts = sorted(map(tuple, disjoint(spark.createDataFrame([e[2:] for e in entries if e[1] == "BT"], "low long, high long")).collect()))
    assert all(a[1] < b[0] for a, b in zip(parts, parts[1:])) and {v for a, b in parts for v in range(a, b + 1)} == {v for e in entries if e[1] == "BT" for v in range(e[2], e[3] + 1)}
