"""What keeps the work of large inputs in line with their size; results stay those of the plain way."""

import csv
import io
import random
import re

from pyspark.sql import functions as F

from ledgerloom import functions, sources
from ledgerloom.operators import mapping, rules, statements
from ledgerloom.plans import scan
from ledgerloom.sources import lines_of, shared, sinks


def test_rows_lie_packed_until_they_are_joined(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x, y" * 50) for i in range(2000)], "_seq int, v string")
    sinks.write_parts(rows, f"{tmp_path}/p", ["_seq"], packed=True)
    packed = sum(p.stat().st_size for p in (tmp_path / "p").glob("part-*"))
    sinks.join_files(spark, sinks.parts_of(spark, f"{tmp_path}/p"), f"{tmp_path}/one.csv")
    assert packed < (tmp_path / "one.csv").stat().st_size / 4
    assert (tmp_path / "one.csv").read_bytes() == ("v\r\n" + f'"{"x, y" * 50}"\r\n' * 2000).encode()
    sinks.write_csv(rows.where("false"), f"{tmp_path}/none.csv", ["_seq"])
    assert (tmp_path / "none.csv").read_bytes() == b""


def test_plain_lines_are_cut_as_quoted_ones_are(spark):
    lines = ["a,b,,\r\n", ",\n", "x\r", " a ,\xa0b ,c\t\n", 'a,"b,""c""" d,e\n', "a,b　\n", "", "é,ß\r\n"]
    rows = spark.createDataFrame([(t,) for t in lines], "text string")
    plan = rows.select(F.transform(sources._fields(F.col("text")), functions.stripped).alias("x"), sources._closed(F.col("text")).alias("closed"), sources._closes(F.col("text")).alias("closes")).collect()
    expected = [[v.strip() for v in next(csv.reader(io.StringIO(t, newline="")), [""])] for t in lines]
    assert [r["x"] for r in plan] == expected
    assert all(r["closed"] for r in plan) and [r["closes"] for r in plan] == [False] * 4 + [True] + [False] * 3


def test_frequent_keys_do_not_share_a_task(spark, monkeypatch):
    monkeypatch.setattr(functions, "HOT_ROWS", 100)
    rows = spark.range(3000).select(F.col("id").alias("_seq"), F.expr("CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN 'k7' WHEN id = 2 THEN NULL ELSE 'k' || id % 10 END").alias("PARTNER"))
    side = spark.createDataFrame([(f"k{i}", i) for i in range(8)], "PARTNER string, bp int")
    found = functions.left_join(rows, "PARTNER", side.hint("merge"))
    plain = rows.join(side, "PARTNER", "left").select("_seq", "PARTNER", "bp")
    assert sorted(map(tuple, found.select("_seq", "PARTNER", "bp").collect())) == sorted(map(tuple, plain.collect()))
    assert "_j" not in found.columns
    hot = functions.left_join(rows.where("PARTNER in ('', 'k7')"), "PARTNER", side.hint("merge"))
    counted = hot.sparkSession.range(1).crossJoin(hot).count()
    assert counted == 2000 + rows.where("PARTNER = 'k7' AND _seq % 3 = 2").count()


def test_what_is_numbered_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(0, 500, 1, 4).mapInArrow(look, "id long")
    out = mapping.numbered(rows, "id", 1, "n").collect()
    assert {r["id"]: r["n"] for r in out} == {i: i + 1 for i in range(500)}
    assert seen.value == 500


def test_short_texts_are_cut_in_their_row_as_long_ones_are_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(statements, "BLOCK_LINES", 150)
    rng = random.Random(5)
    lines = ["LOOP AT t.", "ENDLOOP.", "DO.", "ENDDO.", "x = 1", "y = 'a\"b'.", "* note.", '  z = 2. " end', "", "w = 'it''s' \"q\" r", "3.", "WHILE a.", "\tENDWHILE.", "."]
    texts = [(i, "".join(rng.choice(lines) + rng.choice(["\n", "\r\n", "\r", "\x85"]) for _ in range(rng.choice([0, 1, 5, 100, 140, 300])))) for i in range(60)] + [(60, None), (61, ""), (62, "x = 1")]
    rows = spark.createDataFrame(texts, "path int, text string")
    plain = statements.with_depth(statements.statements(lines_of(rows)))
    columns = ["path", "stmt_no", "line", "text", "loop_depth"]
    found = statements.of_texts(rows)
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    few = statements.of_texts(rows.where("length(text) < 140"))
    assert few.count() > 20 and "Exchange" not in few._jdf.queryExecution().executedPlan().toString()


def test_sources_are_made_once_and_statements_are_searched_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(0, 300, 1, 4).selectExpr("'p' || id AS path", "'SELECT a FROM mard INTO TABLE t.\n\n* x\ny' || id || ' = z(18).' AS text").mapInArrow(look, "path string, text string")
    got = scan.scan(spark, rows, store=True)
    assert got.findings.count() == 600 and got.objects.agg(F.sum("loc"), F.sum("findings")).first()[:] == (600, 600)
    assert seen.value == 300
    plan = rules.findings(spark.createDataFrame([("p", 1, "SELECT a FROM mard.", 0)], "path string, line int, text string, loop_depth int"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SI-TECH-006") == 1


def test_numbers_are_places_in_stored_ranges(spark):
    rows = spark.range(900).select((F.col("id") * 7 % 900).alias("k"))
    out = mapping.numbered(rows, "k", 5, "n", 6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and out.columns == ["k", "n"]
    assert {r["k"]: r["n"] for r in out.collect()} == {i: i + 5 for i in range(900)}


def test_words_lead_to_the_evidence_that_each_rule_gives(spark):
    made = [rules.Rule("A", "", "", "", 1, ("T2", "T1"), (), True), rules.Rule("B", "", "", "", 1, ("t1", "T3", "T2")), rules.Rule("C", "", "", "", 1, ("T1",), (r"\bREST\b",)), rules.Rule("D", "", "", "", 1, ("T3",), (), False, True),
            rules.Rule("E", "", "", "", 1, (), (r"\w+\(18\)", r"\bGO\s+\w+")), rules.Rule("F", "", "", "", 1, (), (r"a|b{2}",))]
    rng = random.Random(3)
    words = ["SELECT", "update", "t1", "T2", "xt3", "t3", "T1_", "rest", "go", "far", "v(18)", "(18)", "'t2'", "bb", "1"]
    rows = spark.createDataFrame([(i, 1, " ".join(rng.choice(words) for _ in range(rng.randrange(8))), i % 2) for i in range(400)], "path int, line int, text string, loop_depth int").cache()
    each = [rows.select("path", F.lit(r.id).alias("rule_id"), r.evidence(F.col("text"), F.col("loop_depth")).alias("evidence")).where("evidence is not null") for r in made]
    expected = sorted(tuple(r) for e in each for r in e.collect())
    assert len({r for _, r, _ in expected}) == 6
    assert sorted(map(tuple, rules.findings(rows, made).select("path", "rule_id", "evidence").collect())) == expected


def test_white_space_is_collapsed_and_lines_are_cut_at_any_end(spark):
    texts = ["a b", " a  b ", "a\tb", "a \t\u3000 b", "a\n\nb c", "\xa0a\x85", "", "x" * 158 + "  y z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    flat = [re.sub(r"[\s\x85]+", " ", t).strip() for t in texts]
    assert [r[0] for r in rows.select(functions.truncate(F.col("t"))).collect()] == [t if len(t) <= 160 else t[:157] + "..." for t in flat]
    texts = ["a\r\r\nb\n\rc", "a\x0bb\x0cc\x1cd\x1de\x1ef\x85g\u2028h\u2029i", "a\nb\n", "\n", "", "a\r\n* b\n\n *c\rd"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    got = sorted(map(tuple, lines_of(rows).collect()))
    assert got == sorted((str(i), n, x) for i, t in enumerate(texts) for n, x in enumerate(t.splitlines(), 1))
    loc = {r["path"]: r["loc"] for r in statements.effective_lines(lines_of(rows)).collect()}
    assert {r["path"]: r["n"] for r in rows.select("path", statements.effective_count(F.col("text")).alias("n")).collect()} == {str(i): loc.get(str(i), 0) for i in range(len(texts))}


def test_many_small_files_share_folders(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 3).selectExpr("concat('s', id % 700) AS name", "CASE WHEN id = 5 THEN NULL ELSE concat('é ', id) END AS value")
    sinks.write_texts(rows, str(tmp_path / "t"))
    files = [p for p in (tmp_path / "t").rglob("*") if p.is_file()]
    assert len(files) == 700 and len({p.parent for p in files}) <= sinks.FOLDERS and all(p.suffix == ".txt" for p in files)
    expected = {}
    for i in range(3000):
        expected.setdefault(f"s{i % 700}", []).append("" if i == 5 else f"é {i}")
    assert {p.stem[5:]: sorted(p.read_text().splitlines()) for p in files} == {n: sorted(v) for n, v in expected.items()}
    assert {r["path"] for r in sources.read_sources(spark, str(tmp_path / "t"), suffix=".txt").select("path").collect()} == set(map(str, files))
    sinks.write_texts(rows.where("false"), str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("*.txt"))


def _shuffle_files(spark):
    return sum("shuffle_" in str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))


def test_rows_stored_in_order_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 5).select((F.col("id") * 1237 % 4000).alias("_seq")).select("_seq", F.expr("md5(string(_seq))").alias("a"), F.expr("IF(_seq % 7 = 0, 'x, \"y\"\r\nz', '')").alias("b"))
    sinks.write_csv(rows, f"{tmp_path}/plain.csv", ["_seq"])
    plain, hadoop = (tmp_path / "plain.csv").read_bytes(), spark._jsc.hadoopConfiguration()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.adaptive.coalescePartitions.enabled")}
    hadoop.set("parquet.block.size", "20000")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        held = shared.stored_in_order(rows, "ordered", ["_seq"])
        for size, cost in (("9k", "1"), ("90k", "1"), ("1g", "1g")):  # parts of files, some files and all files a task
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            made = _shuffle_files(spark)
            sinks.write_parts(held, f"{tmp_path}/p{size}", ["_seq"], columns=["a", "b"], packed=True)
            assert _shuffle_files(spark) == made
            files = sinks.parts_of(spark, f"{tmp_path}/p{size}")
            assert len(files) > (5 if size == "9k" else 4)
            sinks.join_files(spark, files, f"{tmp_path}/joined.csv")
            assert (tmp_path / "joined.csv").read_bytes() == plain
            read = sources.read_csv(spark, f"{tmp_path}/p{size}").orderBy("_seq").select("a", "b").collect()
            assert [tuple(r) for r in read] == [(a, b.strip()) for a, b in list(csv.reader(io.StringIO(plain.decode(), newline="")))[1:]]
    finally:
        hadoop.unset("parquet.block.size")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shuffle_files_go_as_a_query_ends(spark, tmp_path):
    rows, key = spark.range(5000).select(F.xxhash64("id").alias("a")).orderBy("a"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    made, before = _shuffle_files(spark), spark.conf.get(key)
    with shared.shuffles_dropped(spark):
        rows.write.parquet(f"{tmp_path}/r")
    assert _shuffle_files(spark) <= made and spark.conf.get(key) == before
    assert rows.count() == spark.read.parquet(f"{tmp_path}/r").count() == 5000


def test_parts_go_as_they_are_joined(spark, tmp_path):
    spark.range(100).select("id", F.col("id").alias("_seq")).transform(lambda r: sinks.write_parts(r, f"{tmp_path}/p", ["_seq"], 3, packed=True) or r)
    sinks.join_files(spark, sinks.parts_of(spark, f"{tmp_path}/p"), f"{tmp_path}/one.csv", consume=True)
    assert sinks.parts_of(spark, f"{tmp_path}/p") == [] and (tmp_path / "one.csv").read_text().split() == ["id", *map(str, range(100))]
