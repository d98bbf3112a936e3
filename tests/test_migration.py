import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.functions import fixed, ranges, strip, strip_zeros, truncate
from ledgerloom.operators import mapping, quality
from ledgerloom.plans import migration
from ledgerloom.sources import ExtractError, extract_wave, read_csv, sinks

MATERIALS = '''MATNR,MTART,MATKL,MEINS,BRGEW,GEWEI,SPART,XCHPF,MHDHB,ZZ_TEMP_CLASS,MAKTX,WERKS,DISPO
000101,FERT,G1,st,0.085,KG,01,X,365,2-8C,CREAM 50G,P1,D1
000102,FERT,G1,EA,,,01,,,,"Tablet, ""small""",P1,D1
000103,ROH,G2,,1,KG,01,,,,POWDER,P1,D1
000104,ROH,G2,XX,1,KG,01,,,,POWDER B,P1,D1
000105,ROH,G2,KG,1,,01,,,,POWDER C,P1,D1
000106,ROH,G2,KG,1,KG,01,X,,,POWDER D,P1,D1
000107,ZZZ,G2,KG,2.500,KG,01,,10,,CREAM 50G,P1,D1
'''
CUSTOMERS = """KUNNR,NAME1,LAND1,ORT01,PSTLZ,STRAS,BUKRS,AKONT,ZTERM,STCEG,KTOKD
0001,Alpha Ltd,gb,London,E1,High St,GB01,1,Z,GB1,D
0002,ALPHA LTD,GB,Leeds,E1,Low St,GB02,1,Z,GB1,D
0003,Beta,XX,Rome,1,Via,IT01,1,Z,IT1,D
0004,Gamma,DE,Bonn,,Weg,DE01,1,Z,,D
"""
VENDORS = """LIFNR,NAME1,LAND1,ORT01,PSTLZ,STRAS,BUKRS,AKONT,ZTERM,STCEG,KTOKK,ZZ_GMP_AUDITED
9001,alpha ltd,GB,London,E1,High St,GB03,1,Z,GB1,D,X
9002,Delta,,Paris,2,Rue,FR01,1,Z,FR1,D,
9003,Epsilon,FR,Paris,2,Rue,FR01,1,Z,FR1,D,
"""
ITEMS = """BUKRS,BELNR,GJAHR,BUZEI,BLART,HKONT,PARTNER,PARTNER_TYPE,SHKZG,DMBTR,WAERS,BUDAT,ZFBDT
GB01,1,2026,1,DR,10,0001,C,S,100.00,GBP,20260101,20260201
GB02,2,2026,1,DR,10,0002,C,S,50.00,GBP,20260101,
GB01,1,2026,2,DR,20,,,H,100.00,GBP,20260101,
GB02,2,2026,2,DR,20,,,H,50.10,GBP,20260101,
FR01,3,2026,1,KR,10,7777,V,H,5.00,EUR,20260101,20260101
FR01,3,2026,2,KR,10,,,S,5.00,EUR,20260101,
DE01,4,2026,1,DR,10,0004,C,S,1.25,EUR,20260101,
DE01,4,2026,2,DR,20,,,H,1.25,EUR,20260101,
"""
STOCK = """WERKS,LGORT,MATNR,CHARG,CLABS,CINSM,CSPEM,MEINS,VFDAT,HSDAT,ZUSTD
P1,L1,000101,B1,10.500,2,0,ST,20270101,20250101,
P1,L1,000101,B2,1,0,0,KG,20270101,20250101,
P1,L1,000102,B3,1,0,0,EA,20270101,20250101,
P2,L1,000999,B4,1,1,0,EA,,20250101,
P1,L2,000101,B5,4,,0,ST,,20250101,
"""
FILES = {"ecc_mara_material_master.csv": MATERIALS, "ecc_kna1_customers.csv": CUSTOMERS, "ecc_lfa1_vendors.csv": VENDORS, "ecc_open_items.csv": ITEMS, "ecc_batch_stock.csv": STOCK}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("wave")
    for name, text in FILES.items():
        (d / name).write_text(text)
    return d


@pytest.fixture(scope="module")
def wave(spark, folder):
    return migration.run("w", extract_wave(spark, str(folder)))


def ids(wave, name):
    return [(r["rule_id"], r["key"]) for r in wave.cleansed[name].issues.orderBy("_stage", "_at", "_pos").collect()]


def test_material_issues_in_order(wave):
    assert ids(wave, "materials") == [
        ("DQ-MAT-001", "000101"), ("DQ-MAT-005", "000102"), ("DQ-MAT-007", "000102"), ("DQ-MAT-002", "000103"), ("DQ-MAT-003", "000104"), ("DQ-MAT-004", "000105"), ("DQ-MAT-006", "000106"), ("DQ-MAT-008", "000101, 000107")]


def test_partner_issues(wave):
    assert ids(wave, "customers") == [("DQ-CUS-001", "0001"), ("DQ-CUS-003", "0003"), ("DQ-CUS-004", "0004"), ("DQ-CUS-005", "0004"), ("DQ-CUS-007", "0001, 0002")]
    assert ids(wave, "vendors") == [("DQ-VEN-002", "9002"), ("DQ-VEN-006", "9002"), ("DQ-VEN-006", "9003")]


def test_whole_documents_are_rejected(wave):
    c = wave.cleansed["open_items"]
    assert ids(wave, "open_items") == [("DQ-FI-001", "GB02/2/2026"), ("DQ-FI-003", "GB02/2/2026"), ("DQ-FI-002", "FR01/3/2026"), ("DQ-FI-003", "DE01/4/2026")]
    assert [(r["BELNR"], r["BUZEI"]) for r in c.accepted.orderBy("_first", "_seq").collect()] == [("1", "1"), ("1", "2"), ("4", "1"), ("4", "2")]
    assert c.rejected.count() + c.accepted.count() == 8


def test_stock_issues(wave):
    assert ids(wave, "batch_stock") == [("DQ-STK-004", "P1/000101/B1"), ("DQ-STK-005", "P1/000101/B2"), ("DQ-STK-002", "P1/000102/B3"), ("DQ-STK-001", "P2/000999/B4"), ("DQ-STK-004", "P2/000999/B4"), ("DQ-STK-003", "P1/000101/B5")]


def test_partners_merge_and_number_by_first_appearance(wave):
    rows = wave.loads["business_partners"].orderBy("BusinessPartner").collect()
    assert [(r["BusinessPartner"], r["BusinessPartnerName"], r["BusinessPartnerRoles"], r["CompanyCodes"], r["SourceCustomers"], r["SourceVendors"]) for r in rows] == [
        ("1000000", "Alpha Ltd", "FLCU00;FLCU01;FLVN00;FLVN01", "GB01;GB02;GB03", "0001;0002", "9001"), ("1000001", "Gamma", "FLCU00;FLCU01", "DE01", "0004", ""), ("1000002", "Epsilon", "FLVN00;FLVN01", "FR01", "", "9003")]
    assert [(r["SourceType"], r["SourceId"], r["BusinessPartner"]) for r in wave.loads["bp_xref"].orderBy("_seq").collect()][-1] == ("LFA1", "9003", "1000002")


def test_products_and_stock(wave):
    rows = {r["Product"]: r for r in wave.loads["products"].collect()}
    assert rows["101"]["BaseUnit"] == "PCE" and rows["101"]["BatchManagement"] == "true" and rows["102"]["GrossWeight"] == "0.000" and rows["107"]["ProductType"] == "ZZZ" and rows["102"]["ProductDescription"] == 'TABLET, "SMALL"'
    assert {(r["Batch"], r["BaseUnit"], r["StorageConditionClass"]) for r in wave.loads["stock"].collect()} == {("B1", "PCE", "2-8C"), ("B5", "PCE", "2-8C")}


def test_checks_pass_and_tampering_fails(wave):
    rows = {r["id"]: r for r in wave.checks.collect()}
    assert wave.passed and len(rows) == 5 + 3 + 2 + 2 + 1
    assert rows["REC-BP-001"]["note"] == "2 records merged into a shared BP" and rows["REC-STK-P1"]["source_value"] == "14.500" and rows["REC-FI-BAL-GB01"]["target_value"] == "credit 100.00"
    loads = wave.loads | {"open_items": wave.loads["open_items"].withColumn("AmountInCompanyCodeCurrency", F.when(F.col("AccountingDocument") == "4", "9.99").otherwise(F.col("AmountInCompanyCodeCurrency")))}
    assert {r["id"] for r in migration.checks_of(wave.cleansed, loads).where("not passed").collect()} == {"REC-FI-VAL-DE01-EUR"}
    loads = wave.loads | {"products": wave.loads["products"].where("Product <> '101'")}
    failed = migration.checks_of(wave.cleansed, loads).where("not passed").collect()
    assert [(r["id"], r["note"]) for r in failed] == [("REC-CNT-materials", "1 not loaded: 101")]


def test_files(spark, folder, tmp_path):
    assert cli.main(["migrate", "--wave", "w", "--data", str(folder), "--out", str(tmp_path)], spark) == 0
    assert len(list(tmp_path.glob("*.csv"))) == 15
    lines = (tmp_path / "s4_product.csv").read_bytes().split(b"\r\n")
    assert lines[0].startswith(b"Product,ProductType") and b'"TABLET, ""SMALL"""' in lines[2]
    assert json.loads((tmp_path / "reconciliation.json").read_text())["passed"] is True
    assert cli.main(["migrate", "--wave", "w", "--data", str(folder), "--dry-run", "--fail-on-reject"], spark) == 1
    assert cli.main(["migrate", "--data", str(folder / "none")], spark) == 2


def test_a_write_set_is_replaced_as_a_whole(spark, wave, tmp_path, monkeypatch):
    out = tmp_path / "out"
    migration.write(wave, str(out), spark)
    old = {p.name: p.read_bytes() for p in out.iterdir() if p.is_file()}
    assert set(json.loads(old["manifest.json"])["files"]) == {n for n in old if not n.startswith(".")} - {"manifest.json"}
    (out / "notes.txt").write_text("mine")
    with monkeypatch.context() as m:
        m.setattr(migration.render, "reconciliation_markdown", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            migration.write(wave, str(out), spark)
    assert {p.name: p.read_bytes() for p in out.iterdir() if p.is_file()} == old | {"notes.txt": b"mine"} and [p.name for p in tmp_path.iterdir()] == ["out"]
    out.rename(tmp_path / "out.replaced")  # a run that ended between its two renames
    migration.write(wave, str(out), spark)
    assert {p.name: p.read_bytes() for p in out.iterdir() if p.is_file() and not p.name.startswith(".")} == {n: b for n, b in old.items() if not n.startswith(".")} | {"notes.txt": b"mine"} and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_packed_write_set_holds_the_same_records(spark, wave, tmp_path):
    migration.write(wave, str(tmp_path / "plain"), spark)
    migration.write(wave, str(tmp_path / "packed"), spark, packed=True)
    files = sorted(p.name for p in (tmp_path / "plain").glob("*.csv"))
    assert len(files) == 15 and all(f.suffix == ".gz" or f.name == sinks.HEADER for n in files for f in (tmp_path / "packed" / n).iterdir() if f.name[0] not in "._")
    for n in files:
        sinks.join_files(spark, sinks.parts_of(spark, str(tmp_path / "packed" / n)), str(tmp_path / "joined.csv"))
        assert (tmp_path / "joined.csv").read_bytes() == (tmp_path / "plain" / n).read_bytes()
        if (tmp_path / "plain" / n).stat().st_size:
            plain, packed = (read_csv(spark, str(tmp_path / kind / n)) for kind in ("plain", "packed"))
            rows = lambda x: [tuple(r) for r in x.orderBy("_seq").drop("_seq").collect()]
            assert packed.columns == plain.columns and rows(packed) == rows(plain)
    assert all((tmp_path / "packed" / n).read_text() == (tmp_path / "plain" / n).read_text() for n in ("reconciliation.json", "reconciliation.md"))
    assert set(json.loads((tmp_path / "packed" / "manifest.json").read_text())["files"]) == {*files, "reconciliation.json", "reconciliation.md"}
    stored = [c.annotated.stored_at for c in wave.cleansed.values()]
    assert all("_issues" not in spark.read.parquet(p).columns for p in stored)


def test_parts_put_together_are_the_file(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("_seq"), (F.col("id") * 7).cast("string").alias("a"), F.when(F.col("id") % 3 == 0, 'x "y", z\nw\r').when(F.col("id") % 3 == 1, F.lit(None).cast("string")).otherwise(" é ").alias("b,c"))
    sinks.write_csv(rows, str(tmp_path / "one.csv"), ["_seq"])
    sinks.write_parts(rows, str(tmp_path / "many"), ["_seq"], 5)
    files = sinks.parts_of(spark, str(tmp_path / "many"))
    assert len(files) == 6 and b"".join(open(f, "rb").read() for f in files) == (tmp_path / "one.csv").read_bytes()
    text = io.StringIO()
    out = csv.writer(text)
    out.writerow(["a", "b,c"])
    out.writerows((7 * i, ('x "y", z\nw\r', "", " é ")[i % 3]) for i in range(500))
    assert (tmp_path / "one.csv").read_bytes() == text.getvalue().encode()
    sinks.write_csv(rows.where("false"), str(tmp_path / "one.csv"), ["_seq"])
    assert (tmp_path / "one.csv").read_bytes() == b"" and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["many", "one.csv"]


def test_quoted_line_ends_survive_a_migration(spark, folder, tmp_path):
    for name in FILES:
        text = (folder / name).read_text()
        (tmp_path / name).write_text(text.replace("CREAM 50G,", '"CREAM\n50G",').replace("High St", '"High\r\nSt"'), newline="")
    done = migration.run("w", extract_wave(spark, str(tmp_path)))
    assert {r["ProductDescription"] for r in done.loads["products"].collect()} >= {"CREAM\n50G"} and done.passed
    assert "High\r\nSt" in {r["StreetName"] for r in done.loads["business_partners"].collect()}


def test_every_held_back_record_is_named(spark, folder, tmp_path, capsys):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    with open(tmp_path / "ecc_mara_material_master.csv", "a") as f:
        f.writelines(f"{i},ROH,G2,XX,1,KG,01,,,,MANY {i},P1,D1\n" for i in range(2000, 3500))
    assert cli.main(["run", "--wave", "w", "--source", str(tmp_path), "--dry-run", "--fail-on-reject"], spark) == 1
    said = capsys.readouterr()
    assert sum(x.startswith("  DQ-MAT-003 ") for x in said.out.splitlines()) == 1501 and "records held back from the load" in said.err


def test_command_line_forms(spark, folder, tmp_path, capsys):
    base = ["run", "--wave", "w", "--source", str(folder)]
    assert cli.main([*base, "--out", str(tmp_path / "a")], spark) == 0
    said = capsys.readouterr().out
    assert "reconciliation: PASS (0 failed of 13 checks)" in said and "held back from the load:" in said and "merged 2 source records" in said and f"artefacts written to {tmp_path / 'a'}" in said
    assert cli.main([*base, "--dry-run", "--format", "json"], spark) == 0 and json.loads(capsys.readouterr().out)["passed"] is True
    assert cli.main([*base, "--dry-run", "--format", "markdown"], spark) == 0 and "## Checks" in capsys.readouterr().out
    assert cli.main([*base, "--out", str(tmp_path / "b"), "--parts", "3"], spark) == 0 and (tmp_path / "b" / "s4_product.csv").is_dir()
    assert cli.main(["run", "--source", str(folder / "none")], spark) == 2 and "not found" in capsys.readouterr().err


def test_empty_and_odd_inputs(spark, folder, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n")
    assert read_csv(spark, str(tmp_path / "a.csv")).count() == 0
    with pytest.raises(ExtractError):
        read_csv(spark, str(tmp_path / "b.csv"))
    empty = {n: t.where("false") for n, t in extract_wave(spark, str(folder)).items()}
    done = migration.run("e", empty)
    assert done.passed and all(x.count() == 0 for x in done.loads.values())


def test_expressions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first()["x"]
    assert [get(strip_zeros(F.lit(x))) for x in ("000100", "000", "", "0A0")] == ["100", "0", "0", "A0"]
    assert get(strip(F.lit("\t a b\xa0\n"))) == "a b"
    assert [get(fixed(F.lit(x).cast("decimal(38,3)"), 2)) for x in ("2.345", "2.355", "-0.005")] == ["2.34", "2.36", "0.00"]
    assert get(truncate(F.lit("a " * 200))).endswith("...") and len(get(truncate(F.lit("a " * 200)))) == 160
    assert [get(ranges(F.lit(x), [("I", "BT", 1, 5), ("E", "EQ", 3, None)])) for x in (1, 3, 6)] == [True, False, False] and get(ranges(F.lit(1), []))


def test_numbering_is_the_same_for_any_partitioning(spark):
    rows = spark.range(1000).withColumn("k", F.xxhash64("id"))
    a, b = (sorted((r["k"], r["n"]) for r in mapping.numbered(rows.repartition(p), "k", 5, "n", q).collect()) for p, q in ((1, 1), (7, 9)))
    assert a == b and [n for _, n in a] == list(range(5, 1005))


def test_document_side_codes(spark):
    rows = spark.createDataFrame([("d", "S", "5.00", 1), ("d", "H", "5.00", 2), ("d", "Z", "9.00", 3)], "k string, side string, amount string, _seq int")
    assert tuple(quality.document_totals(rows, ["k"], F.col("side"), F.col("amount").cast("decimal(38,2)")).first()[1:3]) == (5, 5)


def _wave_of_published_size(folder):
    """Rows of our own that have the counts of the published wave: records, rejects, warnings, merged partners and checks."""

    def put(name, head, rows):
        text = io.StringIO()
        out = csv.writer(text, lineterminator="\n")
        out.writerow(head.split(","))
        out.writerows(rows)
        (folder / name).write_text(text.getvalue())

    put("ecc_mara_material_master.csv", MATERIALS.split("\n")[0], [
        (f"M{i:02}", "FERT", "G", "" if i == 18 else "KG", "" if i == 3 else "1", "KG", "01", "X" if i < 14 or i == 19 else "", "365" if i < 14 else "", "", "TWIN" if i in (4, 5) else f"TEXT {i}", "P1", "D") for i in range(20)])
    person = lambda i, name, land, tail: (f"{i:04}", name, land, "Town", "" if name == "Anna 5" else "1", "Way", "C1", "1", "Z", "V" + name[-2:], "D", *tail)
    put("ecc_kna1_customers.csv", CUSTOMERS.split("\n")[0], [person(i, "Anna 1" if i == 2 else f"Anna {i}", "XX" if i == 15 else "DE", ()) for i in range(16)])
    put("ecc_lfa1_vendors.csv", VENDORS.split("\n")[0], [person(100 + i, "Anna 7" if i == 9 else "Bert 1" if i == 2 else f"Bert {i}", "" if i == 13 else "DE", ("" if i in (0, 3, 4, 6, 8) else "X",)) for i in range(14)])
    items = [(f"C{d % 5}", d, 2026, n + 1, "DR", "10", "" if n else "9999" if d == 12 else "0001", "C", "SH"[n], "10.00" if (d, n) != (11, 1) else "10.10", "EUR", "20260101", "20260201") for d in range(13) for n in range(2)]
    put("ecc_open_items.csv", ITEMS.split("\n")[0], items)
    of = {14: "M18", 15: "M19", 16: "M01", 17: "M14", 18: "M15", 19: "none"}
    put("ecc_batch_stock.csv", STOCK.split("\n")[0], [(f"P{i % 4}", "L", of.get(i, f"M{i % 14:02}"), f"B{i}", "5", "1" if i < 6 else "0", "0", "ST" if i == 16 else "KG", "" if i == 7 else "20270101", "20250101", "") for i in range(20)])


def test_a_wave_of_the_published_size_has_its_figures(spark, tmp_path):
    _wave_of_published_size(tmp_path)
    done = migration.run("wave0", extract_wave(spark, str(tmp_path)))
    assert {c["object"]: (c["extracted"], c["rejected"], c["loaded"], c["warn"]) for c in done.counts()} == {
        "materials": (20, 2, 18, 2), "customers": (16, 1, 15, 2), "vendors": (14, 1, 13, 6), "open_items": (26, 4, 22, 0), "batch_stock": (20, 6, 14, 7)}
    checks = done.checks.collect()
    assert len(checks) == 22 and all(c["passed"] for c in checks) and done.loads["business_partners"].count() == 25 and done.partners.merged_count().first()["merged"] == 3
    done.release()
