"""Queries that go through files: what is shaped from the driver's tables is written, read as an extract, an inventory or sources, and what the library writes is read back.

A record is compared by the hash of its columns. Names with a line end and quotes take part, so records do not end where lines do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import catalog_wave as wave
from ledgerloom.constants import LOAD_FILES, WAVE_FILES
from ledgerloom.functions import in_range_list
from ledgerloom.operators import rules
from ledgerloom.operators.issues import FIELDS
from ledgerloom.plans import migration
from ledgerloom.sources import exists, extract_wave, lines_of, read_csv, read_inventory, read_sources
from ledgerloom.sources.shared import fresh_path
from ledgerloom.sources.sinks import HEADER, write_csv, write_texts
from ledgerloom.sources.state import State

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _record(columns: list[str] | tuple[str, ...]) -> str:
    """The hash of columns, in either engine. Files know no nulls."""
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in columns) + "))"


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# A name that needs quotes and holds a line end, in every third record.
_NAMED = "CASE WHEN NAME1 <> '' AND length(NAME1) % 3 = 0 THEN NAME1 || ', \"c/o\"' || chr(13) || chr(10) || NAME1 ELSE NAME1 END"


def _columns(name: str) -> list[str]:
    return list(wave._EXTRACTS[name][2])


def _shown(name: str) -> list[str]:
    return [_NAMED if c == "NAME1" else c for c in _columns(name)]


@query(" UNION ALL ".join(f"SELECT '{n}' AS object, {_record(_shown(n))} AS record FROM ({wave._from(n)})" for n in WAVE_FILES))
def S2_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five extracts of a wave, written and extracted again."""
    folder = fresh_path(spark, "extracts")
    for name, file in WAVE_FILES.items():
        rows = wave._extract(spark, sf_dir, name)
        write_csv(rows.selectExpr(*(f"{s} AS {c}" for s, c in zip(_shown(name), _columns(name), strict=True)), "_seq"), f"{folder}/{file}", ["_seq"])
    return _union([rows.select(F.lit(n).alias("object"), F.expr(_record(_columns(n))).alias("record")) for n, rows in extract_wave(spark, folder).items()])


_INVENTORY = ["object_name", "object_type", "path", "module", "owner", "gxp_class", "wave", "monthly_executions", "business_criticality", "validation_package", "remediated_path"]


@query(f"SELECT {', '.join(f'{wave._INVENTORY[c]} AS {c}' for c in _INVENTORY)} FROM customer")
def S3_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory of every customer's object, written and read typed."""
    path = f"{fresh_path(spark, 'inventory')}/inventory.csv"
    write_csv(spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*(f"{wave._INVENTORY[c]} AS {c}" for c in _INVENTORY), "c_custkey AS _seq"), path, ["_seq"])
    return read_inventory(spark, path).select(*_INVENTORY)


@query("SELECT 's' || l_suppkey AS name, count(*) AS n_lines, CAST(sum(length(l_comment)) AS BIGINT) AS n_chars, min(l_comment) AS first FROM (SELECT l_suppkey, 'x' || l_orderkey || ' = ' || l_linenumber || '.' AS l_comment FROM lineitem) GROUP BY 1")
def S4_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source file for each supplier, with a line for each of its items, found below a root and split into lines."""
    root = fresh_path(spark, "sources")
    line = F.expr("'x' || l_orderkey || ' = ' || l_linenumber || '.'")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr("'s' || l_suppkey").alias("name"), line.alias("value"))
    write_texts(rows, root)
    found = read_sources(spark, root, suffix=".txt")
    name = F.regexp_extract("path", "name=([^/.]*)", 1)
    return lines_of(found).groupBy(name.alias("name")).agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"), F.min("text").alias("first"))


# What each file of a write set holds: its columns, and SQL that has them.
_ISSUES = {"materials": "D1_D8_material_issues", "customers": "D9_D15_customer_issues", "vendors": "D9_D15_vendor_issues", "open_items": "D16_D18_open_item_issues", "batch_stock": "D20_D24_stock_issues"}
_LOADS = {
    "products": ("M2_products", ["Product", "ProductType", "ProductGroup", "BaseUnit", "GrossWeight", "WeightUnit", "Division", "BatchManagement", "ShelfLifeDays", "StorageConditionClass", "ProductDescription", "Plant", "MRPController"]),
    "business_partners": ("M5_business_partners", ["BusinessPartner", "BusinessPartnerGrouping", "BusinessPartnerName", "Country", "CityName", "PostalCode", "StreetName", "VATRegistration", "BusinessPartnerRoles", "CompanyCodes", "SourceCustomers", "SourceVendors"]),
    "bp_xref": ("F7_xref", ["SourceType", "SourceId", "BusinessPartner"]),
    "open_items": ("F8_open_item_map", ["CompanyCode", "AccountingDocument", "FiscalYear", "AccountingDocumentItem", "AccountingDocumentType", "GLAccount", "BusinessPartner", "SourcePartner", "DebitCreditCode", "AmountInCompanyCodeCurrency", "CompanyCodeCurrency", "PostingDate", "NetDueDate"]),
    "stock": ("M10_stock_map", ["Product", "Plant", "StorageLocation", "Batch", "UnrestrictedQuantity", "QualityInspectionQuantity", "BlockedQuantity", "BaseUnit", "ShelfLifeExpirationDate", "ManufactureDate", "BatchStatus", "StorageConditionClass"]),
}
_REJECTS = {"materials": (wave._MATERIALS, "ma WHERE bad"), "customers": (wave._CUSTOMERS, "cu WHERE bad"), "vendors": (wave._VENDORS, "ve WHERE bad"), "open_items": (wave._ITEMS, "oi WHERE bad"), "batch_stock": (wave._STOCK, "st WHERE NOT (found AND batch AND mat_unit = MEINS)")}
_FILES = {LOAD_FILES[n]: columns for n, (_, columns) in _LOADS.items()} | {f"exceptions_{n}.csv": list(FIELDS) for n in _ISSUES} | {f"rejected_{n}.csv": _columns(n) for n in _REJECTS}


def _expected() -> str:
    held = {LOAD_FILES[n]: wave.ORACLE_SQL[q] for n, (q, _) in _LOADS.items()} | {f"exceptions_{n}.csv": wave.ORACLE_SQL[q] for n, q in _ISSUES.items()}
    held |= {f"rejected_{n}.csv": f"WITH {ctes} SELECT {', '.join(_columns(n))} FROM {rows}" for n, (ctes, rows) in _REJECTS.items()}
    parts = [f"SELECT '{f}' AS file, {_record(columns)} AS record FROM ({held[f]})" for f, columns in _FILES.items()]
    checks = "SELECT 'reconciliation.json', md5(concat_ws('|', id, source_value, target_value, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END, note)) FROM (" + wave.ORACLE_SQL["R1_wave_checks"] + ")"
    return " UNION ALL ".join([*parts, checks])


@query(_expected())
def K7_write_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the load files, exceptions, rejects and the reconciliation of a whole migration, as it stands in the files. These are packed, as records take twelve times the tables' bytes."""
    out = fresh_path(spark, "wave")
    done = migration.run("tables", {name: wave._extract(spark, sf_dir, name) for name in WAVE_FILES})
    migration.write(done, out, spark, packed=True)
    done.release()
    found = [read_csv(spark, f"{out}/{f}").select(F.lit(f).alias("file"), F.expr(_record([f"`{c}`" for c in columns])).alias("record")) for f, columns in _FILES.items() if exists(spark, f"{out}/{f}/{HEADER}")]  # without rows there is no header
    checks = spark.read.json(f"{out}/reconciliation.json", multiLine=True).select(F.inline("checks"))
    found.append(checks.select(F.lit("reconciliation.json").alias("file"), F.md5(F.concat_ws("|", "id", "source_value", "target_value", "status", "note").cast("binary")).alias("record")))
    return _union(found)


@query(f"WITH {wave._SCANNED}, c(seq, rule_id, title, category, severity, effort_points) AS (VALUES " + ", ".join(f"({i}, '{r[0]}', {wave._quoted(r[1])}, '{r[2]}', '{r[3]}', {r[4]})" for i, r in enumerate(wave.RULES))
       + "), n AS (SELECT rule_id, count(*) AS n FROM fm GROUP BY 1) SELECT seq, c.rule_id, title, category, severity, effort_points, coalesce(n, 0) AS n FROM c LEFT JOIN n ON n.rule_id = c.rule_id")
def S7_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the catalogue, with the findings it has in the sources."""
    counts = wave._scan(spark, sf_dir).findings.groupBy("rule_id").agg(F.count("*").alias("n"))
    rows = rules.catalogue(spark).join(counts, "rule_id", "left")
    return rows.select("seq", "rule_id", "title", "category", "severity", "effort_points", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""SELECT l_orderkey AS order_id, l_linenumber AS item, CASE WHEN bool_or(l_returnflag = 'R') THEN 'X' WHEN bool_or(l_linestatus = 'O') THEN 'E' ELSE '' END AS sent, CAST(max(l_shipdate) AS DATE) + CASE WHEN bool_or(l_returnflag = 'R') THEN 2 WHEN bool_or(l_linestatus = 'O') THEN 1 ELSE 0 END AS date FROM lineitem GROUP BY 1, 2""")
def H8_stored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of sending each item, kept on disk over two runs: all items, then those in error, then those sent, as changes of their keys."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_shipdate").cast("date").alias("shipped"), F.bool_or(F.col("l_linestatus") == "O").alias("failed"), F.bool_or(F.col("l_returnflag") == "R").alias("done"))
    rows = lambda where, sent, days: items.where(where).select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item"), F.lit(sent).alias("sent"), F.date_add("shipped", days).alias("date"))
    state, order = State.create(rows("true", "", 0), fresh_path(spark, "state"), ["order_id", "item"], 16), F.struct("date", "sent")
    state.upsert(rows("failed", "E", 1), order)
    state.upsert(rows("done", "X", 2), order)
    return state.read()


@query("""SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus <> 'P' AND l_orderkey BETWEEN o_orderkey AND o_orderkey + o_custkey % 4)
 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority LIKE '1%' AND l_orderkey BETWEEN o_orderkey - 1 AND o_orderkey + o_custkey % 2) AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '2%') GROUP BY 1""")
def H21_range_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that a list of ranges selects which is as long as the table of orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    entry = lambda where, sign, option, low, high: orders.where(where).selectExpr(f"'{sign}' AS sign", f"'{option}' AS option", f"{low} AS low", f"{high} AS high")
    entries = _union([entry("o_orderstatus <> 'P'", "I", "BT", "o_orderkey", "o_orderkey + o_custkey % 4"), entry("o_orderpriority LIKE '1%'", "E", "BT", "o_orderkey - 1", "o_orderkey + o_custkey % 2"), entry("o_orderpriority LIKE '2%'", "E", "EQ", "o_orderkey", "NULL")])
    rows = in_range_list(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey", entries)
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_linenumber").cast("long").alias("lines"))
