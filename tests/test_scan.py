import json
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.operators import rules, statements
from ledgerloom.plans import render, scan
from ledgerloom.sources import lines_of, read_inventory
from ledgerloom.sources.sinks import texts_of

POSITIVE = {
    "SI-MM-001": "SELECT labst FROM mard INTO TABLE t.", "SI-MM-002": "SELECT * FROM mseg INTO TABLE t.", "SI-MM-003": "DATA x TYPE char18.", "SI-FI-001": "SELECT a FROM bsik INTO TABLE t.", "SI-FI-002": "SELECT a FROM bseg INTO TABLE t.",
    "SI-CO-001": "SELECT a FROM coep INTO TABLE t.", "SI-SD-001": "SELECT SINGLE a FROM vbuk INTO x.", "SI-SD-002": "SELECT a FROM s066 INTO TABLE t.", "SI-MD-001": "UPDATE kna1 SET a = b.", "SI-MD-002": "SELECT a FROM lfa1 INTO TABLE t.",
    "SI-PP-001": "SELECT a FROM mdkp INTO TABLE t.", "SI-OM-001": "SELECT a FROM nast INTO TABLE t.", "SI-QM-001": "SELECT a FROM mch1 INTO TABLE t.", "SI-TECH-001": "EXEC SQL.", "SI-TECH-002": "CALL FUNCTION 'WS_UPLOAD'.",
    "SI-TECH-003": "MOVE a TO b.", "SI-TECH-005": "SELECT * FROM t INTO TABLE x.", "SI-TECH-006": "SELECT a FROM t CLIENT SPECIFIED INTO TABLE x.",
}


def found(spark, text):
    return {(r["rule_id"], r["line"], r["evidence"]) for r in scan.scan(spark, spark.createDataFrame([("a/x.prog.abap", text)], "path string, text string")).findings.collect()}


def test_rules_fire(spark):
    rows = spark.createDataFrame([(f"{r}.prog.abap", t) for r, t in POSITIVE.items()], "path string, text string")
    hits = {(r["path"], r["rule_id"]) for r in scan.scan(spark, rows).findings.collect()}
    assert {(f"{r}.prog.abap", r) for r in POSITIVE} <= hits


def test_words_are_those_that_the_patterns_see(spark):
    """Tables and needed words stand alone, whatever their case; letters of any script and underscores belong to a word."""
    texts = ["SELECT a FROM émard INTO TABLE t.", "SELECT a FROM mard_x INTO TABLE t.", "SELECT a FROM Mard~x INTO TABLE t.", "DATA a(18).", "MOVEx a TO b.", "move a TO b.", "CALL FUNCTION 'upload'.", "SUBMIT rsnast00.", "SELECT a FROM zz WHERE p = rsnast00."]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    hits = {(int(r["path"]), r["rule_id"], r["evidence"]) for r in scan.scan(spark, rows).findings.collect()}
    assert hits == {(2, "SI-MM-001", "MARD"), (3, "SI-MM-003", "a(18)"), (5, "SI-TECH-003", "move a TO"), (6, "SI-TECH-002", "CALL FUNCTION 'upload'"), (8, "SI-OM-001", "rsnast00")}
    assert rules.needed_word(r"\bA\s+LONG\s+WORD\b") == "LONG" and rules.needed_word(r"\w+\(18\)") is None and rules.needed_word(r"\bONE\b|\bTWO\b") is None and rules.needed_word(r"MOVES\s+") is None


def test_rules_that_must_not_fire(spark):
    assert "SI-MM-001" not in {r for r, _, _ in found(spark, "SELECT a FROM marc INTO TABLE t.\nDATA x TYPE TABLE OF mard.\n* SELECT a FROM mard.\nx = 'SELECT a FROM mard'.")}
    assert "SI-MD-001" not in {r for r, _, _ in found(spark, "SELECT a FROM kna1 INTO TABLE t.")}
    assert not {r for r, _, _ in found(spark, "SELECT SINGLE a FROM zt INTO x.\nCOMMIT WORK.")}


def test_loops(spark):
    text = "LOOP AT t.\n  SELECT SINGLE a FROM zt INTO x.\n  COMMIT WORK.\nENDLOOP.\nSELECT a FROM zt INTO x.\n  WRITE x.\n  SELECT b FROM zu INTO TABLE y.\nENDSELECT.\nSELECT a FROM zt INTO TABLE x."
    assert {(r, n) for r, n, _ in found(spark, text)} == {("SI-TECH-004", 2), ("SI-TECH-007", 3), ("SI-TECH-004", 7)}


def parse(text):
    """A plain restatement: comments, statements, depth."""
    out, parts, first, depth = [], [], 0, 0
    for n, line in enumerate(text.splitlines(), 1):
        masked = re.sub("'[^']*'", lambda m: "_" * len(m[0]), line)
        code = "" if line.strip().startswith("*") else line[: masked.rfind('"')] if '"' in masked else line
        code = code.strip()
        if not code:
            continue
        first = first or n
        parts.append(code)
        if code.endswith("."):
            out.append((first, " ".join(parts)))
            parts, first = [], 0
    if parts:
        out.append((first, " ".join(parts)))
    rows = []
    for n, t in out:
        if re.match(r"(?i)(ENDLOOP|ENDDO|ENDWHILE|ENDSELECT)\b", t):
            depth = max(0, depth - 1)
        rows.append((n, t, depth))
        if re.match(r"(?i)(LOOP\s+AT|DO\b|WHILE\b)", t):
            depth += 1
    return rows


def test_statements_match_a_loop_over_lines(spark):
    rng = random.Random(7)
    words = ["LOOP AT t.", "ENDLOOP.", "DO.", "ENDDO.", "x = 1", "y = 'a\"b'.", "* note.", '  z = 2. " end', "", "w = 'it''s' \"q\" r", "  * indented", "q = 3.", "v = 'open \" x", "WHILE a.", "\tENDWHILE."]
    texts = ["\n".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(60)] + ["", "\r\na = 1.\r\n\x0bb = 2. c."]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    got = statements.with_depth(statements.statements(lines_of(rows))).collect()
    for i, t in enumerate(texts):
        assert sorted((r["line"], r["text"], r["loop_depth"]) for r in got if r["path"] == str(i)) == sorted(parse(t)), t


def test_very_long_line(spark):
    rows = spark.createDataFrame([("p", "x = 'a' " * 20000 + '" tail')], "path string, text string")
    assert statements.statements(lines_of(rows)).first()["text"].endswith("'a'")


@pytest.fixture(scope="module")
def estate(tmp_path_factory):
    d = tmp_path_factory.mktemp("estate")
    (d / "src").mkdir()
    (d / "src" / "zone.prog.abap").write_text("TABLES: mkpf.\nLOOP AT t.\nSELECT * FROM mseg INTO TABLE x.\nENDLOOP.\n")
    (d / "src" / "ztwo.clas.abap").write_text("* c\nMOVE a TO b.\n\" only\n")
    (d / "src" / "zthree.prog.abap").write_text("SELECT * FROM zz INTO TABLE x.\n")
    (d / "src" / "ztwo.testclasses.abap").write_text("x.\n")
    (d / "inv.csv").write_text("object_name,object_type,path,module,owner,gxp_class,wave,monthly_executions,business_criticality,validation_package,remediated_path\n"
                               "ZONE,PROG,src/zone.prog.abap,MM,Ann,gxp_critical,wave1,10,high,V-1,\nZTWO,CLAS,./src/ztwo.clas.abap,MM,Bob,gxp_relevant,wave0,5,low,V-2,\nZTHREE,PROG,src/zthree.prog.abap,MM,Cy,non_gxp,wave0,99,critical,,new/x\n")
    return d


def test_backlog(spark, estate):
    got = scan.scan_paths(spark, [str(estate / "src")], read_inventory(spark, str(estate / "inv.csv")))
    report = render.Backlog(got)
    text = lambda sections: "".join(texts_of(sections))
    data, said = json.loads(text(report.json())), text(report.markdown())
    assert [o["object_name"] for o in data["objects"]] == ["ZTWO", "ZONE"] and [o["object_name"] for o in data["remediated"]] == ["ZTHREE"]
    one = data["objects"][1]
    assert [(f["line"], f["rule_id"]) for f in one["findings"]] == [(1, "SI-GXP-001"), (1, "SI-MM-002"), (1, "SI-TECH-003"), (3, "SI-MM-002"), (3, "SI-TECH-004"), (3, "SI-TECH-005")]
    assert one["raw_effort_points"] == 13 + 8 + 2 + 8 + 5 + 1 and one["weighted_effort_points"] == 74.0 and data["objects"][0]["effective_loc"] == 2
    assert data["effort"] == {"raw_points": 39, "weighted_points": 77.0, "engineer_days": 10.3, "validation_overhead_days": 5.1} and data["summary"]["outstanding_findings"] == 7 and data["summary"]["by_wave"] == {"wave0": 1, "wave1": 1}
    assert json.dumps(data, indent=2) == text(report.json())
    assert "| 1 | ZTWO | wave0 |" in said and said.endswith("\n") and not said.endswith("\n\n") and said.index("### ZTWO") < said.index("### ZONE") < said.index("## Target patterns") and "top rules:" in text(report.summary())
    assert said.count("\n| 3 | SI-") == 3


def test_reports_without_findings(spark):
    none = render.Backlog(scan.scan(spark, spark.createDataFrame([("a/x.prog.abap", "x = 1.")], "path string, text string")))
    data = json.loads("".join(texts_of(none.json())))
    assert data["objects"] == data["remediated"] == [] and data["summary"]["objects_scanned"] == 1 and data["effort"]["weighted_points"] == 0
    assert "".join(texts_of(none.markdown())).endswith("## Target patterns\n")


def test_cli(spark, estate, tmp_path, capsys):
    args = ["scan", str(estate / "src"), "--inventory", str(estate / "inv.csv")]
    assert cli.main([*args, "--fail-on", "blocker"], spark) == 1
    assert cli.main([*args, "--wave", "wave0", "--fail-on", "critical"], spark) == 0
    assert cli.main([*args, "--format", "markdown", "--out", str(tmp_path / "b.md")], spark) == 0 and (tmp_path / "b.md").exists()
    assert cli.main(["scan", str(estate / "src"), "--inventory", str(estate / "no.csv")], spark) == 2
    assert cli.main([*args, "--rule", "SI-MM-001", "--exclude-rule", "SI-MM-001", "--fail-on", "minor"], spark) == 0
    capsys.readouterr()
    assert cli.main(["rules"]) == 0 and "SI-GXP-001" in capsys.readouterr().out


def test_filters_and_names(spark):
    assert [r.id for r in rules.selected(["SI-MM-001", "SI-MM-002"], ["SI-MM-002"])] == ["SI-MM-001"]
    names = spark.createDataFrame([("a/zx.prog.abap",), ("b/y.txt",), ("c/z.fugr.abap",)], "p string").select(rules.object_name(F.col("p")).alias("n"))
    assert [r["n"] for r in names.collect()] == ["ZX", "Y", "Z"]


def test_every_outstanding_object_has_a_position(spark):
    """Past the hundredth too, in the order of the SQL; and every rule is among the first ten."""
    import duckdb

    from ledgerloom.catalog import ORACLE_SQL, QUERIES

    sf_dir, base = "/root/testdata/sf0.01", duckdb.connect()
    for name in ("documents", "labels"):
        base.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    got = sorted(map(tuple, QUERIES["F16_positions"](spark, sf_dir).collect()))
    assert got == sorted(base.sql(ORACLE_SQL["F16_positions"]).fetchall())
    assert len(got) > 100 and sorted(p for _, p in got) == list(range(1, len(got) + 1))
    assert list(map(tuple, QUERIES["F29_top_ten_rules"](spark, sf_dir).collect())) == base.sql(ORACLE_SQL["F29_top_ten_rules"]).fetchall()
