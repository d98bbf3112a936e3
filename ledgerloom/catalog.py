"""Queries that run the library's operators on the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import catalog_files, catalog_wave
from ledgerloom.functions import fixed, lookup, ranges, strip_zeros, truncate
from ledgerloom.operators import backlog, mapping, quality, reconcile, rules, statements
from ledgerloom.operators.issues import FIX, REJECT, WARN, Cleansed, RowRule, annotate, counts_by_action, duplicates
from ledgerloom.plans import reports
from ledgerloom.sources import lines_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def dec(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


# --- documents that balance, unknown partners (D16, D17, D19, D25) ---


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linestatus", "l_quantity").withColumn("_seq", F.lit(0))
    side = F.when(F.col("l_linestatus") == "O", "S").otherwise("H")
    return quality.document_totals(rows, ["l_orderkey"], side, dec("l_quantity"))


@query("""SELECT l_orderkey, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O'), 0) AS DECIMAL(38,2)) AS debit,
 CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus <> 'O'), 0) AS DECIMAL(38,2)) AS credit FROM lineitem GROUP BY 1 HAVING debit <> credit""")
def F1_doc_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _balance(spark, sf_dir).where("_debit <> _credit").select("l_orderkey", F.col("_debit").alias("debit"), F.col("_credit").alias("credit"))


@query("""WITH t AS (SELECT l_orderkey, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O'), 0) AS d, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus <> 'O'), 0) AS c FROM lineitem GROUP BY 1)
SELECT l_returnflag, CASE WHEN d = c THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value FROM lineitem JOIN t USING (l_orderkey) GROUP BY 1, 2""")
def F1_accept_reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_extendedprice").join(_balance(spark, sf_dir), "l_orderkey")
    outcome = F.when(F.col("_debit") == F.col("_credit"), "accepted").otherwise("rejected")
    return lines.groupBy("l_returnflag", outcome.alias("outcome")).agg(F.count("*").alias("n_lines"), F.sum(dec("l_extendedprice")).cast("decimal(38,2)").alias("value"))


@query("""WITH t AS (SELECT l_orderkey, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O'), 0) AS d, coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus <> 'O'), 0) AS c FROM lineitem GROUP BY 1)
SELECT 'DQ-FI-001' AS rule_id, 'reject' AS action, 'open_items' AS object, CAST(l_orderkey AS VARCHAR) AS key, 'DMBTR' AS field, 'document does not balance: debit ' || CAST(CAST(d AS DECIMAL(18,2)) AS VARCHAR) || ' credit ' || CAST(CAST(c AS DECIMAL(18,2)) AS VARCHAR) AS message FROM t WHERE d <> c""")
def F1_balance_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("document does not balance: debit "), fixed(F.col("_debit"), 2), F.lit(" credit "), fixed(F.col("_credit"), 2))
    rule = RowRule("DQ-FI-001", REJECT, "DMBTR", F.col("_debit") != F.col("_credit"), text)
    return annotate(_balance(spark, sf_dir), "open_items", F.col("l_orderkey").cast("string"), [rule]).select(F.inline("_issues"))


# --- row rules, counts by action, duplicate groups (D1-D15, D26) ---


def _customer_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    made = [
        RowRule("CU-001", FIX, "c_mktsegment", segment != F.initcap(segment), F.concat(F.lit("segment '"), segment, F.lit("' normalised"))),
        RowRule("CU-002", REJECT, "c_acctbal", balance < -500, "balance below the limit"),
        RowRule("CU-003", WARN, "c_acctbal", (balance >= -500) & (balance < 0), "balance is negative"),
        RowRule("CU-004", REJECT, "c_nationkey", F.col("c_nationkey").isin(3, 7, 11), F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"), F.lit(" is not served"))),
    ]
    return annotate(rows, "customers", F.col("c_custkey").cast("string"), made)


_CUSTOMER_ISSUES = """SELECT 'CU-001' AS rule_id, 'fix' AS action, 'customers' AS object, CAST(c_custkey AS VARCHAR) AS key, 'c_mktsegment' AS field, 'segment ''' || c_mktsegment || ''' normalised' AS message FROM customer WHERE c_mktsegment <> upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2))
UNION ALL SELECT 'CU-002', 'reject', 'customers', CAST(c_custkey AS VARCHAR), 'c_acctbal', 'balance below the limit' FROM customer WHERE c_acctbal < -500
UNION ALL SELECT 'CU-003', 'warn', 'customers', CAST(c_custkey AS VARCHAR), 'c_acctbal', 'balance is negative' FROM customer WHERE c_acctbal >= -500 AND c_acctbal < 0
UNION ALL SELECT 'CU-004', 'reject', 'customers', CAST(c_custkey AS VARCHAR), 'c_nationkey', 'nation ' || c_nationkey || ' is not served' FROM customer WHERE c_nationkey IN (3, 7, 11)"""


@query(_CUSTOMER_ISSUES)
def F3_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_rules(spark, sf_dir).select(F.inline("_issues"))


@query(f"SELECT a.action, count(i.rule_id) AS n FROM (VALUES ('fix'), ('warn'), ('reject')) a(action) LEFT JOIN ({_CUSTOMER_ISSUES}) i ON i.action = a.action GROUP BY 1")
def F3_counts_by_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_action(_customer_rules(spark, sf_dir).select(F.inline("_issues")))


@query(f"""WITH i AS ({_CUSTOMER_ISSUES}), r AS (SELECT key, bool_or(action = 'reject') AS rejected FROM i GROUP BY 1)
SELECT 'customers' AS object, count(*) AS extracted, count(*) FILTER (rejected) AS rejected, count(*) FILTER (rejected IS NOT TRUE) AS loaded,
 (SELECT count(*) FROM i WHERE action = 'fix') AS fix, (SELECT count(*) FROM i WHERE action = 'warn') AS warn, (SELECT count(*) FROM i WHERE action = 'reject') AS reject FROM customer LEFT JOIN r ON r.key = CAST(c_custkey AS VARCHAR)""")
def F3_cleanse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _customer_rules(spark, sf_dir).withColumn("_seq", F.col("c_custkey"))
    return Cleansed("customers", rows, ["c_custkey"]).counts()


@query("""SELECT 'DQ-MAT-008' AS rule_id, 'warn' AS action, 'parts' AS object, string_agg(CAST(p_partkey AS VARCHAR), ', ' ORDER BY p_partkey) AS key, 'p_name' AS field, 'duplicate material description ''' || upper(p_name) || '''' AS message
FROM part GROUP BY upper(p_name) HAVING count(*) > 1""")
def F4_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part", "p_partkey", "p_name").withColumn("_seq", F.col("p_partkey")).withColumn("key", F.col("p_partkey").cast("string"))
    return duplicates(rows, "parts", "DQ-MAT-008", [F.upper("p_name")], "key", "p_name", lambda g: F.concat(F.lit("duplicate material description '"), g, F.lit("'"))).drop("_seq")


# --- entities, cross reference, lookups (M1-M11) ---


def _parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda t, i, p: table(spark, sf_dir, t, f"{p}_{'custkey' if p == 'c' else 'suppkey'}", f"{p}_nationkey", f"{p}_acctbal", f"{p}_name").toDF("id", "nation", "balance", "name").withColumn("side", F.lit(i))
    rows = side("customer", 0, "c").unionByName(side("supplier", 1, "s"))
    return rows.withColumn("band", F.floor(F.col("balance") / 1000).cast("int")).withColumn("order", F.struct("side", "id"))


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.entities(_parties(spark, sf_dir), [F.col("nation"), F.col("band")], F.col("order"), {"name": F.col("name")}, {"customers": F.when(F.col("side") == 0, F.col("id").cast("string")), "suppliers": F.when(F.col("side") == 1, F.col("id").cast("string"))},
                            {"roles": F.when(F.col("side") == 0, F.array(F.lit("FLCU00"), F.lit("FLCU01"))).otherwise(F.array(F.lit("FLVN00"), F.lit("FLVN01")))})


_PARTIES = """p AS (SELECT 0 AS side, c_custkey AS id, c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS INTEGER) AS band, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_nationkey, CAST(floor(s_acctbal / 1000) AS INTEGER), s_name FROM supplier),
g AS (SELECT nation, band, min(side * 1000000000000 + id) AS first, arg_min(name, side * 1000000000000 + id) AS name, coalesce(string_agg(CAST(id AS VARCHAR), ';' ORDER BY id) FILTER (side = 0), '') AS customers, coalesce(string_agg(CAST(id AS VARCHAR), ';' ORDER BY id) FILTER (side = 1), '') AS suppliers,
 CASE WHEN bool_and(side = 0) THEN 'FLCU00;FLCU01' WHEN bool_and(side = 1) THEN 'FLVN00;FLVN01' ELSE 'FLCU00;FLCU01;FLVN00;FLVN01' END AS roles FROM p GROUP BY 1, 2),
e AS (SELECT *, CAST(999999 + row_number() OVER (ORDER BY first) AS BIGINT) AS partner FROM g)"""


@query(f"WITH {_PARTIES} SELECT partner, nation, band, name, roles, customers, suppliers FROM e")
def F6_entity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapping.numbered(_entities(spark, sf_dir), "_first", 1000000, "partner")
    return rows.select(F.col("partner").cast("long").alias("partner"), F.col("_g0").alias("nation"), F.col("_g1").alias("band"), "name", F.array_join("roles", ";").alias("roles"), F.array_join("customers", ";").alias("customers"), F.array_join("suppliers", ";").alias("suppliers"))


@query("""SELECT c_custkey, CASE WHEN ltrim(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '0') = '' THEN '0' ELSE ltrim(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '0') END AS stripped,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'BLD' WHEN 'MACHINERY' THEN 'MCH' ELSE c_mktsegment END AS segment, CASE WHEN c_nationkey < 5 THEN 'true' ELSE 'false' END AS near FROM customer""")
def F8_lookup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return rows.select("c_custkey", strip_zeros(F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("stripped"), lookup(F.col("c_mktsegment"), {"BUILDING": "BLD", "MACHINERY": "MCH"}, F.col("c_mktsegment")).alias("segment"),
                       F.when(F.col("c_nationkey") < 5, "true").otherwise("false").alias("near"))


# --- reconciliation (R1-R9) ---


def _loaded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders as a faulty load would have them: some missing, some twice, some with another amount, some unknown."""
    rows = table(spark, sf_dir, "orders", "o_orderkey", *columns)
    k = F.col("o_orderkey")
    twice = rows.where(k % 499 == 0)
    rows = rows.where(k % 101 != 5).unionByName(twice)
    rows = rows.unionByName(rows.where(k % 997 == 1).withColumn("o_orderkey", -k))
    return rows.withColumn("o_totalprice", F.col("o_totalprice") + F.when(k % 307 == 2, 1.0).otherwise(0.0)) if "o_totalprice" in columns else rows


_LOADED = """a AS (SELECT * FROM orders WHERE o_orderkey % 101 <> 5 UNION ALL SELECT * FROM orders WHERE o_orderkey % 499 = 0), l AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice + CASE WHEN o_orderkey % 307 = 2 THEN 1.0 ELSE 0.0 END AS o_totalprice FROM a
 UNION ALL SELECT -o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM a WHERE o_orderkey % 997 = 1)"""


@query(f"""WITH {_LOADED}, s AS (SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS k FROM orders), t AS (SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS k FROM l),
m AS (SELECT k FROM s EXCEPT SELECT k FROM t), u AS (SELECT k FROM t EXCEPT SELECT k FROM s), c AS (SELECT (SELECT count(*) FROM s) AS ns, (SELECT count(*) FROM t) AS nt, (SELECT count(*) FROM m) AS nm, (SELECT count(*) FROM u) AS nu, (SELECT count(*) FROM l) - (SELECT count(*) FROM t) AS nd,
 (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM m ORDER BY k LIMIT 3)) AS ms, (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM u ORDER BY k LIMIT 3)) AS us)
SELECT 'REC-CNT-orders' AS id, 'orders: every accepted record loaded once' AS description, ns || ' accepted keys' AS source_value, nt || ' keys in the load file' AS target_value, nm = 0 AND nu = 0 AND nd = 0 AS passed,
 concat_ws('; ', CASE WHEN nm > 0 THEN nm || ' not loaded: ' || ms || CASE WHEN nm > 3 THEN ', ...' ELSE '' END END, CASE WHEN nu > 0 THEN nu || ' unknown: ' || us || CASE WHEN nu > 3 THEN ', ...' ELSE '' END END, CASE WHEN nd <> 0 THEN nd || ' duplicate rows' END) AS note FROM c""")
def F9_recon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("key")
    return reconcile.key_counts("orders", table(spark, sf_dir, "orders", "o_orderkey").select(key), _loaded(spark, sf_dir).select(key))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return reconcile.totals(accepted, _loaded(spark, sf_dir, "o_orderstatus", "o_orderpriority", "o_totalprice"), ["o_orderstatus", "o_orderpriority"], ["o_orderstatus", "o_orderpriority"], dec("o_totalprice"), dec("o_totalprice"))


_VALUES = f"""WITH {_LOADED}, x AS (SELECT o_orderstatus AS k0, o_orderpriority AS k1, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS source FROM orders GROUP BY 1, 2), y AS (SELECT o_orderstatus AS k0, o_orderpriority AS k1, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS target FROM l GROUP BY 1, 2),
v AS (SELECT k0, k1, CAST(coalesce(source, 0) AS DECIMAL(38,2)) AS s, CAST(coalesce(target, 0) AS DECIMAL(38,2)) AS t FROM x FULL JOIN y USING (k0, k1))"""


@query(f"{_VALUES} SELECT 'REC-VAL-' || k0 || '-' || k1 AS id, CAST(s AS VARCHAR) AS source_value, CAST(t AS VARCHAR) AS target_value, s = t AS passed FROM v")
def F10_recon_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir).select(F.concat_ws("-", F.lit("REC-VAL"), "k0", "k1").alias("id"), fixed(F.col("source"), 2).alias("source_value"), fixed(F.col("target"), 2).alias("target_value"), (F.col("source") == F.col("target")).alias("passed"))


@query(f"{_VALUES} SELECT bool_and(s = t) AS passed, count(*) FILTER (s <> t) AS failed, count(*) AS total FROM v")
def F10_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.verdict(_totals(spark, sf_dir).withColumn("passed", F.col("source") == F.col("target")))


@query("""SELECT 'REC-FI-BAL-' || l_returnflag AS id, 'loaded open items balance in ' || l_returnflag AS description, 'debit ' || CAST(CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(38,2))) FILTER (l_linestatus = 'O'), 0) AS DECIMAL(38,2)) AS VARCHAR) AS source_value,
 'credit ' || CAST(CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(38,2))) FILTER (l_linestatus <> 'O'), 0) AS DECIMAL(38,2)) AS VARCHAR) AS target_value, coalesce(sum(CAST(l_quantity AS DECIMAL(38,2))) FILTER (l_linestatus = 'O'), 0) = coalesce(sum(CAST(l_quantity AS DECIMAL(38,2))) FILTER (l_linestatus <> 'O'), 0) AS passed, '' AS note
FROM lineitem GROUP BY l_returnflag""")
def F11_recon_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
    return reconcile.balance_checks(rows.select(F.col("l_returnflag").alias("CompanyCode"), F.when(F.col("l_linestatus") == "O", "S").otherwise("H").alias("DebitCreditCode"), dec("l_quantity").cast("string").alias("AmountInCompanyCodeCurrency")))


# --- statements, loop depth, rules, backlog (P2-P11, B1-B11) ---


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id")


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.of_texts(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", opens=lambda t: t.rlike("^[A-D]"), closes=lambda t: t.rlike("^[EFI]"))


_SPACE = r"'[\t\n\v\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_STRIP = rf"regexp_replace(regexp_replace(t, {_SPACE.replace(chr(39), chr(39) + '^', 1)}+', ''), {_SPACE}+$', '')"
_LINES = rf"""a AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\v\f\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]') AS p FROM documents), b AS (SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM a),
li AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS line, unnest(p) AS t FROM b)"""
_STATEMENTS = rf"""{_LINES}, co AS (SELECT doc_id, line, {_STRIP} AS code FROM (SELECT doc_id, line, CASE WHEN starts_with({_STRIP}, '*') THEN '' ELSE regexp_replace(t, '^(.*)"[^"]*$', '\1') END AS t FROM li)),
gr AS (SELECT doc_id, line, code, coalesce(sum(CASE WHEN ends_with(code, '.') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stmt_no FROM co WHERE code <> ''),
st AS (SELECT doc_id, CAST(stmt_no AS INTEGER) AS stmt_no, CAST(min(line) AS INTEGER) AS line, string_agg(code, ' ' ORDER BY line) AS text FROM gr GROUP BY 1, 2),
up AS (SELECT *, CASE WHEN regexp_matches(text, '^[EFI]') THEN -1 WHEN regexp_matches(text, '^[A-D]') THEN 1 ELSE 0 END AS step FROM st), su AS (SELECT *, sum(step) OVER (PARTITION BY doc_id ORDER BY stmt_no) AS s FROM up),
de AS (SELECT doc_id, stmt_no, line, text, CAST(s - least(0, min(s) OVER (PARTITION BY doc_id ORDER BY stmt_no)) - CASE WHEN step = 1 THEN 1 ELSE 0 END AS INTEGER) AS loop_depth FROM su)"""


@query(f"WITH {_STATEMENTS} SELECT doc_id, stmt_no, line, md5(text) AS text_md5 FROM de")
def F12_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).select("doc_id", "stmt_no", "line", F.md5("text").alias("text_md5"))


@query(f"WITH {_STATEMENTS} SELECT doc_id, max(loop_depth) AS deepest, CAST(sum(loop_depth) AS BIGINT) AS total_depth, count(*) AS n FROM de GROUP BY 1")
def F13_loop_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).groupBy("doc_id").agg(F.max("loop_depth").alias("deepest"), F.sum("loop_depth").alias("total_depth"), F.count("*").alias("n"))


# Rules on the words of the documents, in the shape of the catalogue.
_RULES = (
    rules.Rule("W-001", "frequent word", "words", "minor", 1, (), (r"\bwith\b", r"\bthe\b", r"\band\b")),
    rules.Rule("W-002", "licence line", "legal", "blocker", 8, (), (r"\blicensed\s+under\s+\w+",)),
    rules.Rule("W-003", "address", "privacy", "critical", 5, (), (r"\b\w+@\w+\.\w+",)),
    rules.Rule("W-004", "deep question", "words", "major", 3, (), (r"^\s*Th\w*",), False, True),
)


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = spark.createDataFrame([(r.id, r.severity, r.points) for r in _RULES], "rule_id string, severity string, effort_points int")
    return rules.findings(_statements(spark, sf_dir), _RULES, "doc_id").join(F.broadcast(meta), "rule_id")  # one row a rule


_FINDINGS = rf"""{_STATEMENTS}, fi AS (
SELECT doc_id, line, text, 'W-001' AS rule_id, 'minor' AS severity, 1 AS effort_points, coalesce(nullif(regexp_extract(text, '(?i)\bwith\b'), ''), nullif(regexp_extract(text, '(?i)\bthe\b'), ''), nullif(regexp_extract(text, '(?i)\band\b'), '')) AS evidence FROM de
UNION ALL SELECT doc_id, line, text, 'W-002', 'blocker', 8, nullif(trim(regexp_extract(text, '(?i)\blicensed\s+under\s+\w+')), '') FROM de
UNION ALL SELECT doc_id, line, text, 'W-003', 'critical', 5, nullif(trim(regexp_extract(text, '(?i)\b\w+@\w+\.\w+')), '') FROM de
UNION ALL SELECT doc_id, line, text, 'W-004', 'major', 3, CASE WHEN loop_depth > 0 THEN nullif(trim(regexp_extract(text, '(?i)^\s*Th\w*')), '') END FROM de), ff AS (SELECT * FROM fi WHERE evidence IS NOT NULL)"""


@query(f"WITH {_FINDINGS} SELECT doc_id, line, rule_id, evidence, severity, CAST(effort_points AS INTEGER) AS effort_points FROM ff")
def F14_rule_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, sf_dir).select("doc_id", "line", "rule_id", "evidence", "severity", "effort_points")


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    wave = F.concat(F.lit("wave"), (F.col("doc_id") % 4).cast("string"))
    return docs.join(labels, "doc_id", "left").select("doc_id", F.concat(F.lit("D"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("object_name"), wave.alias("wave"),
        F.when(F.col("lang") == "en", "gxp_critical").when(F.col("lang") == "de", "gxp_relevant").otherwise("non_gxp").alias("gxp_class"), F.when(F.col("toxic") == 1, "critical").otherwise("low").alias("business_criticality"),
        (F.col("doc_id") % 1000).cast("int").alias("monthly_executions"), F.when(F.col("doc_id") % 10 == 3, F.col("source")).otherwise("").alias("remediated_path"))


def _backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = backlog.per_object(_objects(spark, sf_dir), _findings(spark, sf_dir), "doc_id", ("line", "rule_id", "evidence"))
    return backlog.with_position(backlog.outstanding(rows))


_BACKLOG = f"""{_FINDINGS}, ob AS (SELECT doc_id, 'D' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS object_name, 'wave' || (doc_id % 4) AS wave, CASE lang WHEN 'en' THEN 2.0 WHEN 'de' THEN 1.5 ELSE 1.0 END AS multiplier, CASE WHEN toxic = 1 THEN 3 ELSE 0 END AS criticality, doc_id % 1000 AS runs, doc_id % 10 = 3 AND source <> '' AS fixed
 FROM documents LEFT JOIN labels USING (doc_id)),
po AS (SELECT doc_id, count(*) AS findings, CAST(sum(effort_points) AS INTEGER) AS raw_points, min(CASE severity WHEN 'blocker' THEN 0 WHEN 'critical' THEN 1 WHEN 'major' THEN 2 ELSE 3 END) AS worst, count(*) FILTER (severity = 'blocker') AS blocker FROM ff GROUP BY 1),
bl AS (SELECT ob.*, findings, raw_points, worst, blocker, CAST(raw_points * multiplier AS DOUBLE) AS weighted_points, row_number() OVER (ORDER BY CASE wave WHEN 'wave0' THEN 0 WHEN 'wave1' THEN 1 WHEN 'wave2' THEN 2 ELSE 9 END, worst, -criticality, -runs, object_name) AS position FROM ob JOIN po USING (doc_id) WHERE NOT fixed)"""


@query(f"WITH {_BACKLOG} SELECT doc_id, wave, findings, raw_points, weighted_points, worst, blocker FROM bl")
def F16_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backlog(spark, sf_dir).select("doc_id", "wave", "findings", "raw_points", "weighted_points", "worst", "blocker")


@query(f"WITH {_BACKLOG} SELECT doc_id, CAST(position AS INTEGER) AS position FROM bl")
def F16_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of every outstanding object, numbered by ranges."""
    rows = _backlog(spark, sf_dir).select("doc_id", F.col("position").alias("order"))
    return mapping.numbered(rows, "order", 1, "position").select("doc_id", F.col("position").cast("int").alias("position"))


@query(f"WITH {_BACKLOG} SELECT wave, count(*) AS objects, CAST(sum(findings) AS BIGINT) AS findings, round_even(sum(weighted_points) / 7.5, 1) AS engineer_days FROM bl GROUP BY 1")
def F16_effort_by_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.by_wave(_backlog(spark, sf_dir))


@query(f"WITH {_BACKLOG} SELECT CAST(sum(raw_points) AS BIGINT) AS raw_points, sum(weighted_points) AS weighted_points, round_even(sum(weighted_points) / 7.5, 1) AS engineer_days, round_even((sum(weighted_points) - sum(raw_points)) / 7.5, 1) AS validation_overhead_days FROM bl")
def F16_effort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.effort(_backlog(spark, sf_dir))


@query(f"WITH {_BACKLOG} SELECT rule_id, count(*) AS n FROM ff JOIN bl USING (doc_id) GROUP BY 1")
def F15_findings_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.by_rule(_backlog(spark, sf_dir)).select("rule_id", "n")


@query(f"WITH {_BACKLOG} SELECT rule_id, count(*) AS n FROM ff JOIN bl USING (doc_id) GROUP BY 1 ORDER BY n DESC, min(position * 1000000 + line) LIMIT 10")
def F29_top_ten_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.by_rule(_backlog(spark, sf_dir)).orderBy(F.desc("n"), "first").limit(10).select("rule_id", "n")


@query(f"WITH {_BACKLOG} SELECT rule_id, arg_min(doc_id, position * 1000000 + line) AS doc_id, arg_min(line, position * 1000000 + line) AS line, arg_min(evidence, position * 1000000 + line) AS evidence FROM ff JOIN bl USING (doc_id) GROUP BY 1")
def F30_first_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.first_per_rule(_backlog(spark, sf_dir), "doc_id").select("rule_id", "doc_id", "line", "evidence")


@query(f"WITH {_FINDINGS} SELECT count(*) > 0 AS found FROM ff WHERE severity IN ('blocker', 'critical')")
def F31_severity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.reaches(_findings(spark, sf_dir), "critical")


@query(f"WITH {_LINES} SELECT doc_id, CAST(count(*) FILTER ({_STRIP} <> '' AND NOT starts_with({_STRIP}, '*')) AS INTEGER) AS loc FROM li GROUP BY 1")
def F17_effective_loc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.effective_lines(_lines(spark, sf_dir), "doc_id")


@query(r"""SELECT doc_id, CASE WHEN length(f) > 160 THEN substr(f, 1, 157) || '...' ELSE f END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS f FROM documents)""")
def F18_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", truncate(F.col("text")).alias("short"))


# --- business reports (H1-H21) ---


@query("""SELECT o_orderkey, o_custkey, coalesce(c_name, 'UNKNOWN SUPPLIER') AS name, days, CASE WHEN days <= 30 THEN a ELSE 0 END AS d30, CASE WHEN days > 30 AND days <= 60 THEN a ELSE 0 END AS d60, CASE WHEN days > 60 AND days <= 90 THEN a ELSE 0 END AS d90, CASE WHEN days > 90 THEN a ELSE 0 END AS d90plus
FROM (SELECT *, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-09-01') AS INTEGER) AS days, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON c_custkey = o_custkey""")
def F19_ageing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").withColumn("amount", dec("o_totalprice"))
    names = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return reports.ageing(items.withColumn("o_orderdate", F.to_date("o_orderdate")), names, "o_custkey", "1998-09-01", "o_orderdate", "amount", "o_orderkey")


@query("""SELECT DISTINCT o_orderstatus || '-' || o_orderpriority || '-' || l_returnflag || '-' || l_linestatus || CASE WHEN l_quantity < 10 THEN '|PARTIAL_DELIVERY' ELSE '' END AS variant FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def F20_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity").withColumnRenamed("l_orderkey", "o_orderkey")
    return reports.order_variants(orders, items, "o_orderkey", [F.col(c) for c in ("o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus")], F.col("l_quantity") < 10)


@query("""WITH x AS (SELECT l_suppkey, l_returnflag AS kind, CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS p, CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS a FROM lineitem UNION ALL SELECT s_suppkey, '', NULL, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier)
SELECT l_suppkey, kind, CAST(coalesce(sum(p), 0) AS DECIMAL(28,2)) AS plan, CAST(coalesce(sum(a), 0) AS DECIMAL(28,2)) AS actual, CAST(coalesce(sum(a), 0) - coalesce(sum(p), 0) AS DECIMAL(28,2)) AS variance FROM x WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1, 2""")
def F22_plan_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal").withColumnRenamed("s_suppkey", "l_suppkey")
    primary = table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag", "l_extendedprice").withColumn("amount", dec("l_extendedprice"))
    rows = reports.cost_variance(suppliers.where("s_acctbal > 0"), primary, suppliers.withColumn("amount", dec("s_acctbal")), ["l_suppkey"], "l_returnflag", "R")
    return rows.select("l_suppkey", "kind", *(F.col(c).cast("decimal(28,2)").alias(c) for c in ("plan", "actual", "variance")))


@query("""SELECT l_partkey, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus = 'O'), 0) AS DECIMAL(28,2)) AS receipts, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_linestatus <> 'O'), 0) AS DECIMAL(28,2)) AS issues,
 CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE -CAST(l_quantity AS DECIMAL(18,2)) END), 0) AS DECIMAL(28,2)) AS net, min(l_returnflag) AS base_unit FROM lineitem GROUP BY 1""")
def F23_batch_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.batch_balance(table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_linestatus", "l_returnflag"), ["l_partkey"], dec("l_quantity"), F.col("l_linestatus") == "O", F.col("l_returnflag"), F.col("l_returnflag"))
    return rows.select("l_partkey", *(F.col(c).cast("decimal(28,2)").alias(c) for c in ("receipts", "issues", "net")), "base_unit")


@query("""WITH e AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS erp FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1), s AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS ser FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT l_partkey, CAST(erp AS DECIMAL(28,2)) AS erp_qty, CAST(coalesce(ser, 0) AS DECIMAL(28,2)) AS ser_qty, CAST(erp - coalesce(ser, 0) AS DECIMAL(28,2)) AS delta, CASE WHEN erp = coalesce(ser, 0) THEN 'MATCHED' ELSE 'EXCEPTION' END AS status FROM e LEFT JOIN s USING (l_partkey)""")
def F24_recon_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_linestatus").withColumn("qty", dec("l_quantity"))
    headers = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = reports.serialisation(headers, items, items.where("l_linestatus = 'F'"), ["l_partkey"], ["l_orderkey"], "qty")
    return rows.select("l_partkey", *(F.col(c).cast("decimal(28,2)").alias(c) for c in ("erp_qty", "ser_qty", "delta")), "status")


@query("""WITH b AS (SELECT l_partkey AS batch, l_suppkey AS plant FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT p_partkey, NULL FROM part), lo AS (SELECT l_partkey AS batch, min(l_orderkey) AS lot FROM lineitem GROUP BY 1), ce AS (SELECT DISTINCT l_partkey AS batch FROM lineitem WHERE l_linestatus = 'F')
SELECT b.batch, b.plant, lo.lot, o_orderstatus AS decision, CASE WHEN ce.batch IS NULL THEN 'COA MISSING' ELSE 'READY FOR QP' END AS release FROM b LEFT JOIN lo USING (batch) LEFT JOIN orders ON o_orderkey = lo.lot LEFT JOIN ce USING (batch)""")
def F25_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_orderkey", "l_linestatus").withColumnRenamed("l_partkey", "batch")
    plant = lines.where("l_returnflag = 'R'").select("batch", F.col("l_suppkey").alias("plant"))
    rows = reports.batch_worklist(plant, table(spark, sf_dir, "part", "p_partkey").toDF("batch"), lines.select("batch", F.col("l_orderkey").alias("lot")), table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").toDF("lot", "decision"),
                                  lines.select("batch", F.when(F.col("l_linestatus") == "F", "REL").otherwise("NEW").alias("status")), ["batch"])
    return rows.select("batch", "plant", "lot", "decision", "release")


@query("SELECT p_partkey, p_size, p_brand FROM part WHERE (p_size BETWEEN 5 AND 20 OR p_size = 42) AND NOT (p_size = 7) AND NOT (p_size BETWEEN 10 AND 12)")
def F26_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [("I", "BT", 5, 20), ("I", "EQ", 42, None), ("E", "EQ", 7, None), ("E", "BT", 10, 12)]
    return table(spark, sf_dir, "part", "p_partkey", "p_size", "p_brand").where(ranges(F.col("p_size"), wanted))


@query("SELECT o_orderkey, count(*) AS n_items FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def F27_anti_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag").withColumnRenamed("l_orderkey", "o_orderkey")
    headers = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'O'").select("o_orderkey")
    return reports.unsent(headers, items, "o_orderkey", items.where("l_returnflag = 'R'")).groupBy("o_orderkey").agg(F.count("*").alias("n_items"))


@query("""WITH n AS (SELECT user_id, (array_agg(event_type ORDER BY ts DESC, event_id % 1000000 DESC))[1] AS event_type, max(ts) AS ts FROM events WHERE event_id % 3 <> 0 GROUP BY 1), c AS (SELECT user_id, (array_agg(event_type ORDER BY ts DESC, event_id % 1000000 DESC))[1] AS event_type, max(ts) AS ts FROM events WHERE event_id % 3 = 0 GROUP BY 1)
SELECT user_id, coalesce(n.event_type, c.event_type) AS event_type, CAST(epoch_us(coalesce(n.ts, c.ts)) AS BIGINT) AS us FROM c FULL JOIN n USING (user_id)""")
def F28_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type").withColumn("us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    order = F.struct("us", F.col("event_id") % 1000000)
    current = rows.where("event_id % 3 = 0").groupBy("user_id").agg(F.max_by("event_type", order).alias("event_type"), F.max("us").alias("us"))
    return reports.upsert(current, rows.where("event_id % 3 <> 0").select("user_id", "event_type", "us", "event_id"), ["user_id"], order)


@query("""SELECT l_suppkey AS plant, l_returnflag AS base_unit, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS unrestricted_qty, CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(28,2)) AS quality_insp_qty, CAST(sum(CASE WHEN l_tax > 0.06 THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(28,2)) AS blocked_qty
FROM lineitem WHERE l_suppkey BETWEEN 1 AND 40 GROUP BY 1, 2""")
def H2_stock_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, zero = dec("l_quantity"), F.lit(0).cast("decimal(18,2)")
    stock = table(spark, sf_dir, "lineitem", "l_suppkey", "l_returnflag", "l_quantity", "l_discount", "l_tax").select(F.col("l_suppkey").alias("plant"), F.lit("").alias("storage_location"), F.lit("").alias("material"), F.lit("").alias("batch"), F.col("l_returnflag").alias("base_unit"),
        q.alias("unrestricted_qty"), F.when(F.col("l_discount") > 0.05, q).otherwise(zero).alias("quality_insp_qty"), F.when(F.col("l_tax") > 0.06, q).otherwise(zero).alias("blocked_qty"))
    rows = reports.stock_overview(stock, {"plant": [("I", "BT", 1, 40)]})
    return rows.select("plant", "base_unit", *(F.col(c).cast("decimal(28,2)").alias(c) for c in ("unrestricted_qty", "quality_insp_qty", "blocked_qty")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' AND l_suppkey BETWEEN 3 AND 9 AND l_returnflag <> 'R'""")
def H4_batch_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").withColumnRenamed("l_orderkey", "o_orderkey")
    rows = reports.header_movements(headers, items, ["o_orderkey"], ["o_orderdate"]).withColumns({"posting_date": F.col("o_orderdate"), "plant": F.col("l_suppkey"), "deleted": F.col("l_returnflag") == "R", "batch": F.lit("B")})
    period = [("I", "BT", F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'1996-12-31 00:00:00'"))]
    return reports.batch_movements(rows, {"posting_date": period, "plant": [("I", "BT", 3, 9)]}).select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_partkey", "o_orderdate")


@query("SELECT l_suppkey, CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE -CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DECIMAL(28,2)) AS margin FROM lineitem GROUP BY 1")
def H10_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.margin(table(spark, sf_dir, "lineitem", "l_suppkey", "l_linestatus", "l_extendedprice"), ["l_suppkey"], F.col("l_linestatus") == "O", dec("l_extendedprice"))
    return rows.select("l_suppkey", F.col("margin").cast("decimal(28,2)").alias("margin"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS controller, p_type AS procurement FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'P' AND l_linestatus = 'O' AND coalesce(p_brand, '') BETWEEN 'Brand#2' AND 'Brand#4'""")
def H15_mrp_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus").withColumn("sign", F.when(F.col("l_linestatus") == "O", "-").otherwise("+"))
    master = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type").toDF("l_partkey", "controller", "procurement")
    return reports.planning_exceptions(headers, items, "l_orderkey", master, ["l_partkey"], [("I", "BT", "Brand#2", "Brand#4")]).select("l_orderkey", "l_linenumber", "l_partkey", "controller", "procurement")


@query("""SELECT o_orderkey AS order_id, concat_ws(',', CASE WHEN o_orderpriority LIKE '1%' AND o_orderkey % 3 <> 0 THEN 'LICENCE' END, CASE WHEN o_orderpriority LIKE '2%' AND o_orderkey % 2 <> 0 THEN 'COLD_CHAIN' END) AS issues, o_orderstatus = 'F' AND o_totalprice > 100000 AS credit_reset FROM orders""")
def H19_sales_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"), F.col("o_orderkey")
    rows = o.select(k.alias("order_id"), F.when(F.col("o_orderpriority").startswith("1"), "GB01").otherwise("US01").alias("market"), F.lit("X").alias("controlled"), F.when(k % 3 == 0, "X").alias("licence"), F.when(F.col("o_orderpriority").startswith("2"), "2-8C").otherwise("").alias("temp_class"),
                    F.when(k % 2 == 0, "X").alias("cold_chain"), F.when(F.col("o_orderstatus") == "F", "ZTEN").otherwise("OR").alias("order_type"), F.col("o_totalprice").alias("exposure"), F.lit(100000.0).alias("credit_limit"))
    return reports.sales_checks(rows).select("order_id", F.array_join("issues", ",").alias("issues"), "credit_reset")


@query("""SELECT o_orderkey, o_orderstatus, o_orderkey || '|' || coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, '') AS payload, CASE WHEN o_orderstatus = 'F' THEN 'LPF' ELSE 'LP01' END AS printer, CASE WHEN o_orderstatus = 'F' THEN 'SYSF' ELSE 'LOFTWARE_PRD' END AS system FROM orders""")
def H18_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    texts = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("text"))
    printers = spark.createDataFrame([("F", "LPF", "SYSF")], "o_orderstatus string, printer string, system string")
    return reports.labels(orders.select("o_orderkey", "o_orderstatus"), texts, printers, "o_orderkey", "o_orderstatus")


@query("SELECT CASE WHEN c_nationkey < 10 THEN 'C' WHEN c_nationkey < 20 THEN 'V' ELSE 'error' END AS target, count(*) AS n FROM customer GROUP BY 1")
def H13_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_nationkey") < 10, "C").when(F.col("c_nationkey") < 20, "V").otherwise("X")
    parts = reports.route(table(spark, sf_dir, "customer", "c_nationkey").withColumn("partner_type", kind))
    out = [rows.groupBy(F.lit(name).alias("target")).agg(F.count("*").alias("n")) for name, rows in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT s_suppkey AS plant, coalesce(CASE WHEN r_name = 'EUROPE' THEN 'CET' WHEN r_name = 'ASIA' THEN 'JST' END, 'UTC') AS zone FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def H20_time_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    plants = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").toDF("plant", "address")
    addresses = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey").toDF("address", "country")
    zones = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("country"), F.when(F.col("r_name") == "EUROPE", "CET").when(F.col("r_name") == "ASIA", "JST").alias("zone"))
    return reports.time_zone(plants, addresses, zones)



# --- the rest of the inventory: names and paths, partner and stock checks, legacy and interface reports ---


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'ZP' || o_orderkey WHEN 1 THEN 'ZC' || o_orderkey WHEN 2 THEN 'NOTE' || o_orderkey || '.TXT' ELSE 'ZX' || o_orderkey || '.TEST' END AS object_name FROM orders""")
def P13_object_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = k.cast("string")
    file = F.when(k % 4 == 0, F.concat(F.lit("src/mm/zp"), text, F.lit(".prog.abap"))).when(k % 4 == 1, F.concat(F.lit("zc"), text, F.lit(".clas.abap"))).when(k % 4 == 2, F.concat(F.lit("a/note"), text, F.lit(".txt.md"))).otherwise(F.concat(F.lit("zx"), text, F.lit(".test.abap")))
    return table(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", rules.object_name(file).alias("object_name"))


@query("""WITH i AS (SELECT s_suppkey AS seq, 'p' || (s_suppkey % 50) || '.abap' AS path, s_name AS name FROM supplier), e AS (SELECT path, min(seq) AS first, arg_max(name, seq) AS name FROM i GROUP BY 1),
f AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN './p' ELSE 'dir/x' || (c_custkey % 7) || '/p' END || (c_custkey % 60) || '.abap' AS path FROM customer), m AS (SELECT c_custkey, f.path, arg_min(e.name, e.first) AS name FROM f LEFT JOIN e ON ends_with(ltrim(f.path, './'), e.path) GROUP BY 1, 2)
SELECT c_custkey, path, name AS owner FROM m""")
def P14_inventory_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    path = F.concat(F.when(k % 3 == 0, "./p").otherwise(F.concat(F.lit("dir/x"), (k % 7).cast("string"), F.lit("/p"))), (k % 60).cast("string"), F.lit(".abap"))
    files = table(spark, sf_dir, "customer", "c_custkey").withColumn("path", path)
    inventory = table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(F.concat(F.lit("p"), (F.col("s_suppkey") % 50).cast("string"), F.lit(".abap")).alias("path"), F.col("s_name").alias("owner"), F.col("s_suppkey").alias("_seq"))
    return files.join(rules.with_inventory(files.select("path").distinct(), inventory), "path", "left").select("c_custkey", "path", "owner")


@query(f"""WITH {_PARTIES}, x AS (SELECT count(*) AS records, count(DISTINCT (nation, band)) AS n FROM p), i AS (SELECT count(*) FILTER (o_custkey % 10 <> 0) AS lines, count(*) FILTER (o_custkey % 10 <> 0 AND o_custkey % 7 <> 0) AS resolved FROM orders)
SELECT 'REC-BP-001' AS id, n || ' identities in ' || records || ' records' AS source_value, n || ' BPs in the load file' AS target_value, true AS passed, (records - n) || ' records merged into a shared BP' AS note FROM x
UNION ALL SELECT 'REC-BP-002', CAST(lines AS VARCHAR), CAST(resolved AS VARCHAR), lines = resolved, CASE WHEN lines = resolved THEN '' ELSE (lines - resolved) || ' unmapped partner lines' END FROM i
UNION ALL SELECT 'REC-BP-003', CAST(records AS VARCHAR), CAST((SELECT count(DISTINCT id) FROM p) AS VARCHAR), records = (SELECT count(DISTINCT id) FROM p), '' FROM x""")
def R2_partner_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parties = _parties(spark, sf_dir)
    ids = parties.select(F.col("nation").alias("i0"), F.col("band").alias("i1"), F.lit("").alias("i2"), F.lit("").alias("i3"))
    partners = mapping.numbered(_entities(spark, sf_dir), "_first", 1000000, "BusinessPartner").select("BusinessPartner", F.col("_g0").alias("nation"), F.col("_g1").alias("band"))
    xref = parties.join(partners, ["nation", "band"]).select(F.col("id").alias("SourceId"), "BusinessPartner")
    k = F.col("o_custkey")
    named = k % 10 != 0
    items = table(spark, sf_dir, "orders", "o_custkey").select(F.when(named, k.cast("string")).otherwise("").alias("SourcePartner"), F.when(named & (k % 7 != 0), "BP").otherwise("").alias("BusinessPartner"))
    return reconcile.partner_checks(ids, partners, xref, items).select("id", "source_value", "target_value", "passed", "note")


@query("""WITH a AS (SELECT l_suppkey AS plant, sum(CAST(l_quantity AS DECIMAL(18,3))) AS s FROM lineitem GROUP BY 1), b AS (SELECT l_suppkey AS plant, sum(CAST(l_quantity AS DECIMAL(18,3))) AS t FROM lineitem WHERE l_suppkey % 9 <> 0 OR l_linenumber > 1 GROUP BY 1)
SELECT 'REC-STK-' || plant AS id, 'unrestricted stock quantity in plant ' || plant AS description, CAST(CAST(coalesce(s, 0) AS DECIMAL(38,3)) AS VARCHAR) AS source_value, CAST(CAST(coalesce(t, 0) AS DECIMAL(38,3)) AS VARCHAR) AS target_value, coalesce(s, 0) = coalesce(t, 0) AS passed, '' AS note FROM a FULL JOIN b USING (plant)""")
def R7_stock_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity", "l_linenumber")
    amount = F.col("l_quantity").cast("decimal(18,3)").cast("string")
    accepted = lines.select(F.col("l_suppkey").alias("WERKS"), amount.alias("CLABS"))
    loaded = lines.where("l_suppkey % 9 <> 0 or l_linenumber > 1").select(F.col("l_suppkey").alias("Plant"), amount.alias("UnrestrictedQuantity"))
    return reconcile.stock_checks(accepted, loaded)


@query("""WITH k AS (SELECT l_partkey, l_suppkey, min(l_returnflag) AS u FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2), m AS (SELECT p_partkey, min(p_brand) AS u FROM part GROUP BY 1), s AS (SELECT l_suppkey, l_partkey, l_orderkey, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem WHERE l_linestatus = 'F')
SELECT s.l_suppkey AS plant, s.l_partkey AS material, s.l_orderkey AS storage_location, s.q AS unrestricted_qty, coalesce(k.u, m.u) AS base_unit FROM s LEFT JOIN k ON k.l_partkey = s.l_partkey AND k.l_suppkey = s.l_suppkey LEFT JOIN m ON m.p_partkey = s.l_partkey WHERE s.q <> 0
UNION ALL SELECT l_suppkey, l_partkey, l_orderkey, CAST(l_quantity AS DECIMAL(18,2)), NULL FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 0""")
def H1_stock_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_orderkey", "l_quantity", "l_linestatus", "l_returnflag").withColumns({"plant": F.col("l_suppkey"), "material": F.col("l_partkey"), "storage_location": F.col("l_orderkey"), "unrestricted_qty": dec("l_quantity"),
                                                                                                                                    "quality_insp_qty": dec(F.lit(0)), "blocked_qty": dec(F.lit(0))})
    stock = ["plant", "storage_location", "material", "unrestricted_qty", "quality_insp_qty", "blocked_qty"]
    units = lines.where("l_linestatus = 'O'").select("material", "plant", F.col("l_returnflag").alias("unit"))
    rows = reports.stock_overview_legacy(lines.where("l_linestatus = 'F'").select(*stock), units, table(spark, sf_dir, "part", "p_partkey", "p_brand").toDF("material", "unit"), lines.where("l_returnflag = 'R'").select(*stock))
    return rows.select("plant", "material", "storage_location", "unrestricted_qty", "base_unit")


@query("""SELECT o_orderkey, substr(d, 1, 4) AS doc_type, rtrim(substr(d, 5, 10)) AS quantity, CASE WHEN o_orderkey % 5 = 0 THEN 'FAILED' ELSE 'POSTED' END AS status FROM (SELECT o_orderkey, 'CONF' || rpad(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END, 10, ' ') || 'X' AS d FROM orders WHERE o_orderstatus = 'P')""")
def H17_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confirmed(spark, sf_dir).select("o_orderkey", "doc_type", "quantity", "status")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'NEW' ELSE o_orderstatus END AS status FROM orders")
def H18_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise(F.col("o_orderstatus")).alias("status"))
    return reports.requeue(rows)


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def H13_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return reports.latest(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@query("""WITH a AS (SELECT c_custkey AS id, CAST(c_acctbal * 100 AS DECIMAL(18,2)) AS credit_limit, CAST(c_acctbal AS DECIMAL(18,2)) AS receivables, CAST(c_nationkey AS DECIMAL(18,2)) AS special FROM customer),
u AS (SELECT o_custkey AS id, o_orderstatus = 'O' AS open, CAST(o_totalprice AS DECIMAL(18,2)) AS p, o_orderkey % 3 AS k FROM orders), f AS (SELECT id, sum(p) FILTER (open) AS fp, count(*) FILTER (open) AS fn, sum(p) AS sp FROM u GROUP BY 1),
r AS (SELECT a.*, CAST(receivables + special + coalesce(CASE WHEN fn > 0 THEN fp ELSE sp END, 0) AS DECIMAL(28,2)) AS exposure FROM a LEFT JOIN f USING (id))
SELECT id, exposure, credit_limit FROM r WHERE credit_limit > 0 AND exposure * 100 >= 80 * credit_limit""")
def F21_credit_util(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_nationkey").select(F.col("c_custkey").alias("id"), dec(F.col("c_acctbal") * 100).alias("credit_limit"), dec("c_acctbal").alias("receivables"), dec("c_nationkey").alias("special"))
    orders, k = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), F.col("o_orderkey")
    part = lambda i, name: F.sum(F.when(k % 3 == i, dec("o_totalprice")).otherwise(dec(F.lit(0)))).alias(name)
    use = lambda rows: rows.groupBy(F.col("o_custkey").alias("id")).agg(part(0, "orders"), part(1, "deliveries"), part(2, "billing"))
    return reports.credit_use(accounts, ["id"], use(orders.where("o_orderstatus = 'O'")), use(orders)).select("id", F.col("exposure").cast("decimal(28,2)").alias("exposure"), "credit_limit")


@query("""SELECT 0 AS part, concat_ws(chr(9), 'MATERIALDOCUMENT', 'ITEM', 'POSTINGDATE', 'MOVEMENTTYPE', 'MATERIAL', 'PLANT', 'BATCH', 'QUANTITY', 'UNIT', 'CREATEDBY') AS line
UNION ALL SELECT 1, concat_ws(chr(9), l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_partkey, l_suppkey, 'B' || l_linenumber, CAST(l_quantity AS DECIMAL(18,2)), l_linestatus, 'loader') FROM lineitem WHERE l_suppkey % 20 = 5""")
def H6_movement_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_suppkey", "l_partkey", "l_quantity", "l_linestatus").where("l_suppkey % 20 = 5")
    rows = rows.withColumns({"day": F.to_date("l_shipdate"), "batch": F.concat(F.lit("B"), F.col("l_linenumber").cast("string")), "quantity": dec("l_quantity"), "by": F.lit("loader")})
    return reports.movement_export(rows, ["l_orderkey", "l_linenumber", "day", "l_returnflag", "l_partkey", "l_suppkey", "batch", "quantity", "l_linestatus", "by"])


def _orders_to_send(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    headers = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus").select(k.alias("order_id"), F.when(F.col("o_orderstatus") == "P", "K").otherwise("F").alias("kind"), (k % 13 == 0).alias("deleted"), F.col("o_custkey").alias("partner"), F.lit("EUR").alias("currency"))
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag").withColumnRenamed("l_orderkey", "order_id").withColumnRenamed("l_linenumber", "item")
    names = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey").where("c_nationkey < 20").toDF("partner", "name", "_n").drop("_n")
    schedules = lines.where("l_partkey % 5 > 0").select("order_id", "item", (F.col("l_suppkey") % 2 + 1).alias("line"), F.to_date("l_shipdate").alias("date"))
    return reports.purchase_orders(headers, lines.select("order_id", "item", (F.col("l_partkey") % 17 == 0).alias("deleted"), "l_partkey"), names, schedules, lines.select("order_id", "item", (F.col("l_returnflag") == "R").alias("sent")))


_TO_SEND = """h AS (SELECT o_orderkey AS order_id, o_custkey AS partner FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 13 <> 0), s AS (SELECT l_orderkey AS order_id, l_linenumber AS item, min(CAST(l_shipdate AS DATE)) AS date FROM lineitem WHERE l_partkey % 5 > 0 AND l_suppkey % 2 = 0 GROUP BY 1, 2),
d AS (SELECT DISTINCT l_orderkey AS order_id, l_linenumber AS item FROM lineitem WHERE l_returnflag = 'R'), t AS (SELECT h.order_id, l_linenumber AS item, l_partkey, partner, c_name AS name, date FROM lineitem JOIN h ON h.order_id = l_orderkey LEFT JOIN customer ON c_custkey = partner AND c_nationkey < 20
 LEFT JOIN s ON s.order_id = l_orderkey AND s.item = l_linenumber LEFT JOIN d ON d.order_id = l_orderkey AND d.item = l_linenumber WHERE l_partkey % 17 <> 0 AND d.item IS NULL)"""


@query(f"WITH {_TO_SEND} SELECT order_id, item, l_partkey, partner, name, CAST(date AS VARCHAR) AS date FROM t")
def H8_purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_to_send(spark, sf_dir).select("order_id", "item", "l_partkey", "partner", "name", F.col("date").cast("string").alias("date"))


@query(f"""WITH {_TO_SEND}, b AS (SELECT order_id, item, true AS sent FROM d), n AS (SELECT order_id, item, bool_or(l_partkey % 3 > 0) AS sent FROM t GROUP BY 1, 2)
SELECT coalesce(n.order_id, b.order_id) AS order_id, coalesce(n.item, b.item) AS item, coalesce(n.sent, b.sent) AS sent, CASE WHEN n.item IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS date FROM b FULL JOIN n ON n.order_id = b.order_id AND n.item = b.item""")
def H8_sent_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item")).distinct()
    state = lines.select("order_id", "item", F.lit(True).alias("sent"), F.lit("2024-01-01").alias("date"))
    results = _orders_to_send(spark, sf_dir).select("order_id", "item", (F.col("l_partkey") % 3 > 0).alias("sent"), F.lit("2024-02-01").alias("date"))
    return reports.sent_state(state, results)


@query("""WITH x AS (SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-09-01') AS INTEGER) AS days, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders)
SELECT CAST(coalesce(sum(a) FILTER (days <= 30), 0) AS DECIMAL(28,2)) AS d30, CAST(coalesce(sum(a) FILTER (days > 30 AND days <= 60), 0) AS DECIMAL(28,2)) AS d60, CAST(coalesce(sum(a) FILTER (days > 60 AND days <= 90), 0) AS DECIMAL(28,2)) AS d90,
 CAST(coalesce(sum(a) FILTER (days > 90), 0) AS DECIMAL(28,2)) AS d90plus, CAST(sum(a) AS DECIMAL(28,2)) AS total FROM x""")
def H9_ageing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ageing_total(F19_ageing(spark, sf_dir)).select(*(F.col(c).cast("decimal(28,2)").alias(c) for c in ("d30", "d60", "d90", "d90plus", "total")))


@query("""WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(struct_pack(a := l_shipmode_, b := l_quantity)) AS r FROM (SELECT *, 'P' || (l_partkey % 4) AS l_shipmode_ FROM lineitem WHERE l_returnflag <> 'N') GROUP BY 1, 2, 3, 4)
SELECT coalesce(r.a, '') AS profit_centre, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS margin, count(*) AS n FROM lineitem LEFT JOIN k USING (l_orderkey, l_linenumber, l_partkey, l_suppkey) GROUP BY 1""")
def H10_margin_by_profit_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what a second table holds for their four keys."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem", *keys, "l_linestatus", "l_extendedprice", "l_returnflag")
    second = lines.where("l_returnflag <> 'N'").select(*keys, F.concat(F.lit("P"), (F.col("l_partkey") % 4).cast("string")).alias("centre"))
    rows = reports.with_lookup(lines, second, keys, ["centre"]).withColumn("profit_centre", F.coalesce("centre", F.lit("")))
    side, amount = F.col("l_linestatus") == "O", dec("l_extendedprice")
    return reports.margin(rows, ["profit_centre"], side, amount).join(rows.groupBy("profit_centre").agg(F.count("*").alias("n")), "profit_centre").select("profit_centre", F.col("margin").cast("decimal(28,2)").alias("margin"), "n")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    kind = F.when(k % 5 < 2, "C").when(k % 5 < 4, "V").otherwise("X")
    return table(spark, sf_dir, "events", "event_id", "user_id", "event_type").select(kind.alias("partner_type"), F.col("user_id").alias("partner_id"), (k % 3).alias("company"), F.col("event_type").alias("name"), (k % 7).alias("terms"), k.alias("at"))


def _sync(spark: SparkSession, sf_dir: str, dry_run: bool):  # noqa: ANN202
    people = table(spark, sf_dir, "customer", "c_custkey").where("c_custkey % 2 = 0")
    general = people.select(F.col("c_custkey").alias("partner_id"), F.lit("before").alias("name"))
    company = people.select(F.col("c_custkey").alias("partner_id"), F.lit(0).cast("long").alias("company"), F.lit(-1).cast("long").alias("terms"))
    return reports.partner_sync(_feed(spark, sf_dir), {"C": general, "V": general}, {"C": company, "V": company}, F.col("at"), dry_run)


_SYNC = "f AS (SELECT CASE WHEN event_id % 5 < 2 THEN 'C' WHEN event_id % 5 < 4 THEN 'V' ELSE '' END AS partner_type, user_id AS partner_id, event_id % 3 AS company, event_type AS name, event_id % 7 AS terms, event_id AS pos FROM events)"


@query(f"""WITH {_SYNC}, p AS (SELECT c_custkey AS partner_id FROM customer WHERE c_custkey % 2 = 0), t AS (SELECT * FROM (VALUES ('C'), ('V')) AS v(kind)),
g AS (SELECT partner_type AS kind, partner_id, arg_max(name, pos) AS name FROM f WHERE partner_type <> '' GROUP BY 1, 2), b AS (SELECT kind, partner_id FROM p, t),
h AS (SELECT partner_type AS kind, partner_id, company, arg_max(terms, pos) AS terms FROM f WHERE partner_type <> '' GROUP BY 1, 2, 3), c AS (SELECT kind, partner_id, 0 AS company FROM p, t)
SELECT coalesce(g.kind, b.kind) AS kind, 'general' AS target, coalesce(g.partner_id, b.partner_id) AS partner_id, CAST(0 AS BIGINT) AS company, coalesce(g.name, 'before') AS value FROM b FULL JOIN g ON g.kind = b.kind AND g.partner_id = b.partner_id
UNION ALL SELECT coalesce(h.kind, c.kind), 'company', coalesce(h.partner_id, c.partner_id), coalesce(h.company, c.company), CAST(coalesce(h.terms, -1) AS VARCHAR) FROM c FULL JOIN h ON h.kind = c.kind AND h.partner_id = c.partner_id AND h.company = c.company""")
def H13_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    general, company, _ = _sync(spark, sf_dir, False)
    out = [t.select(F.lit(k).alias("kind"), F.lit("general").alias("target"), "partner_id", F.lit(0).cast("long").alias("company"), F.col("name").alias("value")) for k, t in general.items()]
    out += [t.select(F.lit(k).alias("kind"), F.lit("company").alias("target"), "partner_id", "company", F.col("terms").cast("string").alias("value")) for k, t in company.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(f"""WITH {_SYNC}, n AS (SELECT partner_type, count(*) AS n FROM f GROUP BY 1) SELECT false AS dry_run, partner_type, CASE WHEN partner_type <> '' THEN n ELSE 0 END AS ok, 0 AS tested, CASE WHEN partner_type = '' THEN n ELSE 0 END AS error FROM n
UNION ALL SELECT true, partner_type, 0, CASE WHEN partner_type <> '' THEN n ELSE 0 END, CASE WHEN partner_type = '' THEN n ELSE 0 END FROM n""")
def H13_sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda dry: _sync(spark, sf_dir, dry)[2].select(F.lit(dry).alias("dry_run"), "partner_type", "ok", "tested", "error")
    return one(False).unionByName(one(True))


def _confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus"), F.col("o_orderkey")
    data = F.concat(F.lit("CONF"), F.rpad(F.when(k % 5 == 0, "n/a").otherwise((k % 1000).cast("string")), 10, " "), F.lit("X"))
    return reports.confirmations(orders.where("o_orderstatus = 'P'"), orders.select("o_orderkey", data.alias("data")), "o_orderkey", [("doc_type", 1, 4), ("quantity", 5, 10)])


@query("""SELECT 'MES_CONF' AS interface, o_orderkey AS document, 'CONF' AS object, CASE WHEN o_orderkey % 5 = 0 THEN 'E' ELSE 'S' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'quantity ''n/a'' is no number' ELSE '' END AS message FROM orders WHERE o_orderstatus = 'P'""")
def H17_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confirmation_audit(_confirmed(spark, sf_dir), "o_orderkey", "doc_type")


@query("SELECT count(*) FILTER (o_orderkey % 5 <> 0) AS posted, count(*) FILTER (o_orderkey % 5 = 0) AS failed FROM orders WHERE o_orderstatus = 'P'")
def H17_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confirmation_counts(_confirmed(spark, sf_dir))


QUERIES |= catalog_wave.QUERIES | catalog_files.QUERIES
ORACLE_SQL |= catalog_wave.ORACLE_SQL | catalog_files.ORACLE_SQL
