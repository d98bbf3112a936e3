"""Queries that run the migration and the scan as a whole: extracts and sources are shaped from the driver's tables, and every rule of the library judges them.

The shape of an extract is a list of SQL expressions that both engines read; what the library makes of it is written out again in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.constants import DB_STATEMENT, ISO_COUNTRIES, LOOP_CLOSE, LOOP_OPEN, OBJECT_RULE, RULES, SET_BASED, SEVERITIES, UOM_ISO, VAT_COUNTRIES, WRITE_STATEMENT
from ledgerloom.functions import strip_zeros
from ledgerloom.operators import backlog, mapping, quality, reconcile, rules
from ledgerloom.operators.issues import FIELDS, Cleansed, union
from ledgerloom.plans import migration, scan
from ledgerloom.sources.shared import stored

# --- extracts ---

_TWICE = "(VALUES (0), (1)) AS v(r)"
_EXTRACTS = {
    "materials": (f"part CROSS JOIN {_TWICE}", "r = 0 OR p_partkey % 20 = 0", {
        "MATNR": "lpad(CAST(p_partkey AS STRING), 18, '0')", "MTART": "CASE p_partkey % 5 WHEN 0 THEN 'FERT' WHEN 1 THEN 'HALB' WHEN 2 THEN 'ROH' WHEN 3 THEN 'VERP' ELSE 'DIEN' END", "MATKL": "'G' || (p_partkey % 9)",
        "MEINS": "CASE WHEN r = 1 THEN 'KG' ELSE CASE p_partkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'kg' WHEN 2 THEN 'Kg' WHEN 3 THEN 'XX' WHEN 4 THEN 'st' WHEN 5 THEN 'KG' WHEN 6 THEN 'L' ELSE 'EA' END END",
        "BRGEW": "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS STRING) || '.500' END", "GEWEI": "CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'ZZ' ELSE 'KG' END", "SPART": "'01'",
        "XCHPF": "CASE WHEN p_partkey % 3 > 0 THEN 'X' ELSE '' END", "MHDHB": "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '365' END", "ZZ_TEMP_CLASS": "CASE WHEN p_partkey % 5 = 1 THEN '2-8C' ELSE '' END",
        "MAKTX": "CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END", "WERKS": "'W' || (p_partkey % 5)", "DISPO": "'D1'"}, "CAST(r AS BIGINT) * 1000000000 + p_partkey"),
    "customers": ("customer", "true", {
        "KUNNR": "lpad(CAST(c_custkey AS STRING), 10, '0')", "NAME1": "CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'Shared ' || (c_custkey % 40) ELSE c_name END",
        "LAND1": "CASE c_custkey % 9 WHEN 0 THEN 'gb' WHEN 1 THEN 'De' WHEN 2 THEN '' WHEN 3 THEN 'XX' WHEN 4 THEN 'US' WHEN 5 THEN 'FR' WHEN 6 THEN 'BE' WHEN 7 THEN 'IE' ELSE 'CH' END", "ORT01": "'City ' || (c_custkey % 10)",
        "PSTLZ": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'P' || (c_custkey % 3) END", "STRAS": "'Street ' || c_custkey", "STCEG": "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'V' || (c_custkey % 2) END", "BUKRS": "'C' || (c_custkey % 3)"}, "c_custkey"),
    "vendors": ("supplier", "true", {
        "LIFNR": "lpad(CAST(s_suppkey AS STRING), 10, '0')", "NAME1": "CASE WHEN s_suppkey % 13 = 0 THEN '' WHEN s_suppkey % 2 = 0 THEN 'SHARED ' || (s_suppkey % 40) ELSE s_name END",
        "LAND1": "CASE s_suppkey % 9 WHEN 0 THEN 'gb' WHEN 1 THEN 'De' WHEN 2 THEN '' WHEN 3 THEN 'XX' WHEN 4 THEN 'US' WHEN 5 THEN 'FR' WHEN 6 THEN 'BE' WHEN 7 THEN 'IE' ELSE 'CH' END", "ORT01": "'Town ' || (s_suppkey % 10)",
        "PSTLZ": "CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'p' || (s_suppkey % 3) END", "STRAS": "''", "STCEG": "CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'V' || (s_suppkey % 2) END", "BUKRS": "'C' || (s_suppkey % 4)", "ZZ_GMP_AUDITED": "CASE WHEN s_suppkey % 3 = 0 THEN 'X' ELSE '' END"}, "s_suppkey"),
    "open_items": (f"orders CROSS JOIN {_TWICE}", "true", {
        "BUKRS": "'C' || (o_orderkey % 4)", "BELNR": "lpad(CAST(o_orderkey - o_orderkey % 16 AS STRING), 10, '0')", "GJAHR": "'2024'", "BUZEI": "lpad(CAST(o_orderkey % 16 * 2 + r + 1 AS STRING), 3, '0')", "BLART": "'DZ'", "HKONT": "'0000' || o_orderstatus",
        "PARTNER": "CASE WHEN r = 0 THEN lpad(CAST(CASE WHEN o_orderkey % 23 = 0 THEN o_custkey ELSE 4 + o_custkey % 3 * 40 END AS STRING), 10, '0') ELSE '' END", "SHKZG": "CASE WHEN o_orderkey % 97 = 0 THEN 'X' WHEN r = 0 THEN 'S' ELSE 'H' END",
        "DMBTR": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(CASE WHEN r = 1 AND o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS STRING)", "WAERS": "CASE WHEN o_orderkey % 4 = 1 THEN 'GBP' ELSE 'EUR' END", "BUDAT": "'20240131'",
        "ZFBDT": "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '20240201' END"}, "CAST(o_orderkey AS BIGINT) * 2 + r"),
    "batch_stock": ("lineitem", "true", {
        "MATNR": "CASE WHEN l_orderkey % 17 = 0 THEN '9999' ELSE lpad(CAST(l_partkey AS STRING), 18, '0') END", "WERKS": "'W' || (l_suppkey % 5)", "LGORT": "'L' || (l_linenumber % 2)", "CHARG": "'B' || l_orderkey || '-' || l_linenumber",
        "CLABS": "CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(CAST(l_quantity AS DECIMAL(18,3)) AS STRING) END", "CINSM": "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE '2.5' END", "CSPEM": "'0'",
        "MEINS": "CASE WHEN l_orderkey % 3 = 0 THEN 'KG' ELSE 'EA' END", "VFDAT": "CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE '20251231' END", "HSDAT": "'20240101'", "ZUSTD": "''"}, "CAST(l_orderkey AS BIGINT) * 10 + l_linenumber"),
}


def _extract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, where, columns, seq = _EXTRACTS[name]
    rows = spark.read.parquet(f"{sf_dir}/{source.split()[0]}.parquet")
    if "CROSS" in source:
        rows = rows.withColumn("r", F.explode(F.array(F.lit(0), F.lit(1))))
    return rows.where(where).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()), f"{seq} AS _seq")


def _from(name: str) -> str:
    source, where, columns, seq = _EXTRACTS[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())}, {seq} AS seq FROM {source} WHERE {where}"


def _in(values) -> str:  # noqa: ANN001
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_IDENTITY = "upper(NAME1), upper(LAND1), upper(PSTLZ), upper(STCEG)"


def _partner_sql(name: str, key: str, short: str) -> str:
    """CTEs x, with the fix applied, and xi, the row issues."""
    p = "DQ-CUS" if name == "customers" else "DQ-VEN"
    x = f"{short}0 AS ({_from(name)}), {short} AS (SELECT * REPLACE (upper(LAND1) AS LAND1), LAND1 AS raw, {key} AS id, NAME1 = '' OR LAND1 = '' AS nameless, NAME1 = '' OR LAND1 = '' OR upper(LAND1) NOT IN {_in(ISO_COUNTRIES)} AS bad FROM {short}0)"
    issue = lambda n, action, field, text, where: f"SELECT '{p}-{n}' AS rule_id, '{action}' AS action, '{name}' AS object, id AS key, '{field}' AS field, {text} AS message FROM {short} WHERE {where}"
    made = [issue("001", "fix", "LAND1", "'country ''' || raw || ''' upper-cased'", "raw <> '' AND raw <> upper(raw)"), issue("002", "reject", "NAME1", "'name or country missing, cannot create a business partner'", "nameless"),
            issue("003", "reject", "LAND1", "'''' || LAND1 || ''' is not a valid ISO country code'", "NOT nameless AND bad"), issue("004", "warn", "PSTLZ", "'postal code missing, address will not be validated'", "PSTLZ = ''"),
            issue("005", "warn", "STCEG", "'VAT registration missing for an EU/UK partner'", f"STCEG = '' AND LAND1 IN {_in(VAT_COUNTRIES)}")]
    if name == "vendors":
        made.append(issue("006", "warn", "ZZ_GMP_AUDITED", "'supplier has no GMP audit flag, confirm before cutover'", "ZZ_GMP_AUDITED <> 'X'"))
    made.append(f"SELECT '{p}-007', 'warn', '{name}', string_agg(id, ', ' ORDER BY seq), 'NAME1', 'records merge into one business partner: ' || upper(min(NAME1)) FROM {short} WHERE NOT bad GROUP BY {_IDENTITY} HAVING count(*) > 1")
    return f"{x}, {short}i AS ({' UNION ALL '.join(made)})"


_CUSTOMERS, _VENDORS = _partner_sql("customers", "KUNNR", "cu"), _partner_sql("vendors", "LIFNR", "ve")
_MATERIALS = f"""ma0 AS ({_from('materials')}), ma AS (SELECT * REPLACE (upper(MEINS) AS MEINS, CASE WHEN BRGEW = '' THEN '0.000' ELSE BRGEW END AS BRGEW, upper(MAKTX) AS MAKTX), MEINS AS unit, BRGEW AS weight, MAKTX AS label,
 upper(MEINS) = '' OR upper(MEINS) NOT IN {_in(UOM_ISO)} OR (BRGEW <> '' AND GEWEI = '') OR (XCHPF = 'X' AND MHDHB = '') AS bad FROM ma0), di AS (SELECT MATNR, arg_max(MEINS, seq) AS mat_unit, arg_max(XCHPF, seq) AS managed, arg_max(ZZ_TEMP_CLASS, seq) AS temp FROM ma WHERE NOT bad GROUP BY 1)"""


def _material_issue(n: str, action: str, field: str, text: str, where: str) -> str:
    return f"SELECT 'DQ-MAT-{n}' AS rule_id, '{action}' AS action, 'materials' AS object, MATNR AS key, '{field}' AS field, {text} AS message FROM ma WHERE {where}"


_MATERIAL_ISSUES = " UNION ALL ".join((
    _material_issue("001", "fix", "MEINS", "'base unit ''' || unit || ''' upper-cased'", "unit <> '' AND unit <> upper(unit)"), _material_issue("002", "reject", "MEINS", "'base unit of measure is missing'", "MEINS = ''"),
    _material_issue("003", "reject", "MEINS", "'no ISO mapping for base unit ''' || MEINS || ''''", f"MEINS <> '' AND MEINS NOT IN {_in(UOM_ISO)}"), _material_issue("004", "reject", "GEWEI", "'gross weight supplied without a weight unit'", "weight <> '' AND GEWEI = ''"),
    _material_issue("005", "warn", "BRGEW", "'gross weight is missing, loaded as zero'", "weight = ''"), _material_issue("006", "reject", "MHDHB", "'batch managed material without total shelf life (GMP)'", "XCHPF = 'X' AND MHDHB = ''"),
    _material_issue("007", "fix", "MAKTX", "'description normalised to upper case'", "label <> '' AND label <> upper(label)"),
    "SELECT 'DQ-MAT-008', 'warn', 'materials', string_agg(MATNR, ', ' ORDER BY seq), 'MAKTX', 'duplicate material description ''' || MAKTX || '''' FROM ma GROUP BY MAKTX HAVING count(*) > 1"))
_ITEMS = f"""{_CUSTOMERS}, {_VENDORS}, ids AS (SELECT id FROM cu WHERE NOT bad UNION SELECT id FROM ve WHERE NOT bad), oi0 AS ({_from('open_items')}),
oi1 AS (SELECT *, BUKRS || '/' || BELNR || '/' || GJAHR AS doc, CAST(DMBTR AS DECIMAL(38,2)) AS amount, PARTNER <> '' AND PARTNER NOT IN (SELECT id FROM ids) AS unknown FROM oi0),
oi2 AS (SELECT doc, CAST(coalesce(sum(amount) FILTER (SHKZG = 'S'), 0) AS DECIMAL(38,2)) AS d, CAST(coalesce(sum(amount) FILTER (SHKZG = 'H'), 0) AS DECIMAL(38,2)) AS c, min(seq) AS first, count(*) FILTER (unknown) AS strangers FROM oi1 GROUP BY 1),
oi AS (SELECT oi1.*, d, c, first, d <> c OR strangers > 0 AS bad FROM oi1 JOIN oi2 USING (doc))"""
_STOCK = f"""{_MATERIALS}, st0 AS ({_from('batch_stock')}), st AS (SELECT st0.*, mat_unit, managed, temp, di.MATNR IS NOT NULL AS found, coalesce(managed = 'X', false) AS batch, WERKS || '/' || st0.MATNR || '/' || CHARG AS id FROM st0 LEFT JOIN di ON di.MATNR = st0.MATNR),
sa AS (SELECT * FROM st WHERE found AND batch AND mat_unit = MEINS)"""


def _stock_issue(n: str, action: str, field: str, text: str, where: str) -> str:
    return f"SELECT 'DQ-STK-{n}' AS rule_id, '{action}' AS action, 'batch_stock' AS object, id AS key, '{field}' AS field, {text} AS message FROM st WHERE {where}"


_STOCK_ISSUES = " UNION ALL ".join((
    _stock_issue("001", "reject", "MATNR", "'stock for a material that is not in the migrated master'", "NOT found"), _stock_issue("002", "reject", "CHARG", "'batch stock for a material that is not batch managed'", "found AND NOT batch"),
    _stock_issue("005", "reject", "MEINS", "'stock is in ''' || MEINS || ''' but the material master says ''' || mat_unit || ''', so the quantity cannot be loaded without a unit decision'", "found AND mat_unit <> MEINS"),
    _stock_issue("003", "warn", "VFDAT", "'batch has no expiry date'", "found AND batch AND VFDAT = ''"),
    _stock_issue("004", "warn", "CINSM", "'stock in quality inspection at cutover, needs a usage decision before go-live'", "CINSM NOT IN ('', '0')")))
_BPS = f"""{_CUSTOMERS}, {_VENDORS}, pa AS (SELECT 0 AS side, seq, id, 'KNA1' AS kind, NAME1, LAND1, ORT01, PSTLZ, STRAS, STCEG, BUKRS FROM cu WHERE NOT bad UNION ALL SELECT 1, seq, id, 'LFA1', NAME1, LAND1, ORT01, PSTLZ, STRAS, STCEG, BUKRS FROM ve WHERE NOT bad),
pb AS (SELECT *, side * 1000000000 + seq AS place, upper(NAME1) AS i0, upper(LAND1) AS i1, upper(PSTLZ) AS i2, upper(STCEG) AS i3 FROM pa),
pg AS (SELECT i0, i1, i2, i3, CAST(999999 + row_number() OVER (ORDER BY min(place)) AS STRING) AS bp, arg_min(NAME1, place) AS NAME1, arg_min(LAND1, place) AS LAND1, arg_min(ORT01, place) AS ORT01, arg_min(PSTLZ, place) AS PSTLZ, arg_min(STRAS, place) AS STRAS, arg_min(STCEG, place) AS STCEG,
 CASE WHEN bool_and(side = 0) THEN 'FLCU00;FLCU01' WHEN bool_and(side = 1) THEN 'FLVN00;FLVN01' ELSE 'FLCU00;FLCU01;FLVN00;FLVN01' END AS roles, array_to_string(list_sort(list_distinct(list(BUKRS))), ';') AS codes,
 coalesce(string_agg(id, ';' ORDER BY place) FILTER (side = 0), '') AS customers, coalesce(string_agg(id, ';' ORDER BY place) FILTER (side = 1), '') AS vendors FROM pb GROUP BY 1, 2, 3, 4),
xr AS (SELECT kind, id, bp, place, side FROM pb JOIN pg USING (i0, i1, i2, i3)), lo AS (SELECT id, arg_max(bp, place) AS bp FROM xr GROUP BY 1)"""

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _materials(spark: SparkSession, sf_dir: str) -> Cleansed:
    return quality.cleanse_materials(_extract(spark, sf_dir, "materials"))


def _partners(spark: SparkSession, sf_dir: str) -> list[Cleansed]:
    return [quality.cleanse_partners(_extract(spark, sf_dir, name), name, key) for name, key in (("customers", "KUNNR"), ("vendors", "LIFNR"))]


def _items(spark: SparkSession, sf_dir: str) -> Cleansed:
    ids = [c.accepted.select(F.col(key).alias("partner")) for c, key in zip(_partners(spark, sf_dir), ("KUNNR", "LIFNR"), strict=True)]
    return quality.cleanse_open_items(_extract(spark, sf_dir, "open_items"), ids[0].unionByName(ids[1]))


def _stock(spark: SparkSession, sf_dir: str) -> tuple[Cleansed, DataFrame]:
    dimension = mapping.material_dimension(_materials(spark, sf_dir).accepted)
    return quality.cleanse_batch_stock(_extract(spark, sf_dir, "batch_stock"), dimension), dimension


# --- D1 to D24 ---


@query(f"WITH {_MATERIALS} {_MATERIAL_ISSUES}")
def D1_D8_material_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materials(spark, sf_dir).issues.select(*FIELDS)


@query(f"WITH {_CUSTOMERS} SELECT * FROM cui")
def D9_D15_customer_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partners(spark, sf_dir)[0].issues.select(*FIELDS)


@query(f"WITH {_VENDORS} SELECT * FROM vei")
def D9_D15_vendor_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partners(spark, sf_dir)[1].issues.select(*FIELDS)


@query(f"""WITH {_ITEMS} SELECT 'DQ-FI-001' AS rule_id, 'reject' AS action, 'open_items' AS object, doc AS key, 'DMBTR' AS field, 'document does not balance: debit ' || CAST(d AS STRING) || ' credit ' || CAST(c AS STRING) AS message FROM oi WHERE d <> c AND seq = first
UNION ALL SELECT 'DQ-FI-002', 'reject', 'open_items', doc, 'PARTNER', 'partner ' || PARTNER || ' is not in the migrated master data' FROM oi WHERE unknown
UNION ALL SELECT 'DQ-FI-003', 'warn', 'open_items', doc, 'ZFBDT', 'open item has no baseline date, ageing will be wrong' FROM oi WHERE PARTNER <> '' AND ZFBDT = ''""")
def D16_D18_open_item_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).issues.select(*FIELDS)


@query(f"WITH {_ITEMS} SELECT BELNR, BUKRS, BUZEI, CAST(row_number() OVER (ORDER BY first, seq) AS INTEGER) AS position FROM oi WHERE NOT bad")
def D19_document_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted lines in the order in which they are loaded: documents by their first lines."""
    rows = _items(spark, sf_dir).accepted.withColumn("order", F.struct("_first", "_seq"))
    return mapping.numbered(rows, "order", 1, "position").select("BELNR", "BUKRS", "BUZEI", F.col("position").cast("int").alias("position"))


@query(f"WITH {_ITEMS} SELECT doc, count(*) AS n, count(*) FILTER (unknown) AS n_unknown FROM oi WHERE bad GROUP BY 1")
def D17_rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _items(spark, sf_dir)
    return done.annotated.where("_reject").groupBy(mapping.key_of("BUKRS", "BELNR", "GJAHR").alias("doc")).agg(F.count("*").alias("n"), F.count_if("_unknown").alias("n_unknown"))


@query(f"WITH {_STOCK} {_STOCK_ISSUES}")
def D20_D24_stock_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stock(spark, sf_dir)[0].issues.select(*FIELDS)


# --- M2 to M12 ---


@query(f"""WITH {_MATERIALS} SELECT CASE WHEN ltrim(MATNR, '0') = '' THEN '0' ELSE ltrim(MATNR, '0') END AS Product, MTART AS ProductType, MATKL AS ProductGroup, CASE MEINS {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in UOM_ISO.items())} END AS BaseUnit, BRGEW AS GrossWeight,
 CASE GEWEI {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in UOM_ISO.items())} ELSE GEWEI END AS WeightUnit, SPART AS Division, CASE WHEN XCHPF = 'X' THEN 'true' ELSE 'false' END AS BatchManagement, MHDHB AS ShelfLifeDays, ZZ_TEMP_CLASS AS StorageConditionClass, MAKTX AS ProductDescription,
 WERKS AS Plant, DISPO AS MRPController FROM ma WHERE NOT bad""")
def M2_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_materials(_materials(spark, sf_dir).accepted).drop("_seq")


def _business_partners(spark: SparkSession, sf_dir: str) -> mapping.Partners:
    return mapping.business_partners(*(c.accepted for c in _partners(spark, sf_dir)))


@query(f"""WITH {_BPS} SELECT bp AS BusinessPartner, 'BPGS' AS BusinessPartnerGrouping, NAME1 AS BusinessPartnerName, LAND1 AS Country, ORT01 AS CityName, PSTLZ AS PostalCode, STRAS AS StreetName, STCEG AS VATRegistration, roles AS BusinessPartnerRoles, codes AS CompanyCodes,
 customers AS SourceCustomers, vendors AS SourceVendors FROM pg""")
def M5_business_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _business_partners(spark, sf_dir).partners.drop("_seq")


@query(f"WITH {_BPS} SELECT kind AS SourceType, id AS SourceId, bp AS BusinessPartner FROM xr")
def F7_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _business_partners(spark, sf_dir).xref.select("SourceType", "SourceId", "BusinessPartner")


@query(f"WITH {_BPS} SELECT id, bp FROM lo")
def M6_xref_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _business_partners(spark, sf_dir).lookup()


@query(f"WITH {_BPS} SELECT count(*) - count(DISTINCT bp) AS merged FROM xr")
def F7_merged_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _business_partners(spark, sf_dir).merged_count()


@query(f"""WITH {_ITEMS}, {_BPS.split('pa AS', 1)[1].join(('pa AS', ''))} SELECT BUKRS AS CompanyCode, BELNR AS AccountingDocument, GJAHR AS FiscalYear, BUZEI AS AccountingDocumentItem, BLART AS AccountingDocumentType, HKONT AS GLAccount, coalesce(bp, '') AS BusinessPartner, PARTNER AS SourcePartner,
 SHKZG AS DebitCreditCode, DMBTR AS AmountInCompanyCodeCurrency, WAERS AS CompanyCodeCurrency, BUDAT AS PostingDate, ZFBDT AS NetDueDate FROM oi LEFT JOIN lo ON lo.id = PARTNER WHERE NOT bad""")
def F8_open_item_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_open_items(_items(spark, sf_dir).accepted, _business_partners(spark, sf_dir).lookup()).drop("_first", "_seq")


@query(f"""WITH {_STOCK} SELECT CASE WHEN ltrim(MATNR, '0') = '' THEN '0' ELSE ltrim(MATNR, '0') END AS Product, WERKS AS Plant, LGORT AS StorageLocation, CHARG AS Batch, CLABS AS UnrestrictedQuantity, CINSM AS QualityInspectionQuantity, CSPEM AS BlockedQuantity,
 CASE mat_unit {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in UOM_ISO.items())} END AS BaseUnit, VFDAT AS ShelfLifeExpirationDate, HSDAT AS ManufactureDate, ZUSTD AS BatchStatus, temp AS StorageConditionClass FROM sa""")
def M10_stock_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, dimension = _stock(spark, sf_dir)
    return mapping.map_stock(done.accepted, dimension).drop("_seq")


@query(f"WITH {_MATERIALS} SELECT MATNR, mat_unit AS MEINS, managed AS XCHPF, temp AS ZZ_TEMP_CLASS FROM di")
def F8_last_duplicate_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.material_dimension(_materials(spark, sf_dir).accepted).select("MATNR", "MEINS", "XCHPF", "ZZ_TEMP_CLASS")


@query(f"WITH {_STOCK} SELECT WERKS || '/' || ltrim(MATNR, '0') || '/' || LGORT || '/' || CHARG AS key, count(*) AS n FROM sa GROUP BY 1")
def M12_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stock(spark, sf_dir)[0].accepted.groupBy(mapping.key_of("WERKS", strip_zeros(F.col("MATNR")), "LGORT", "CHARG").alias("key")).agg(F.count("*").alias("n"))


# --- the wave as a whole ---


@query(f"""WITH {_STOCK}, {_ITEMS}, mi AS ({_MATERIAL_ISSUES}), si AS ({_STOCK_ISSUES}), n AS (
 SELECT 'materials' AS object, count(*) AS extracted, count(*) FILTER (bad) AS rejected, (SELECT count(*) FROM mi WHERE action = 'fix') AS fix, (SELECT count(*) FROM mi WHERE action = 'warn') AS warn, (SELECT count(*) FROM mi WHERE action = 'reject') AS reject FROM ma
 UNION ALL SELECT 'customers', count(*), count(*) FILTER (bad), (SELECT count(*) FROM cui WHERE action = 'fix'), (SELECT count(*) FROM cui WHERE action = 'warn'), (SELECT count(*) FROM cui WHERE action = 'reject') FROM cu
 UNION ALL SELECT 'vendors', count(*), count(*) FILTER (bad), (SELECT count(*) FROM vei WHERE action = 'fix'), (SELECT count(*) FROM vei WHERE action = 'warn'), (SELECT count(*) FROM vei WHERE action = 'reject') FROM ve
 UNION ALL SELECT 'open_items', count(*), count(*) FILTER (bad), 0, count(*) FILTER (PARTNER <> '' AND ZFBDT = ''), count(*) FILTER (unknown) + count(*) FILTER (d <> c AND seq = first) FROM oi
 UNION ALL SELECT 'batch_stock', count(*), count(*) - (SELECT count(*) FROM sa), 0, (SELECT count(*) FROM si WHERE action = 'warn'), (SELECT count(*) FROM si WHERE action = 'reject') FROM st)
SELECT object, extracted, rejected, extracted - rejected AS loaded, fix, warn, reject FROM n""")
def D25_wave_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = [_materials(spark, sf_dir), *_partners(spark, sf_dir), _items(spark, sf_dir), _stock(spark, sf_dir)[0]]
    out = done[0].counts()
    for c in done[1:]:
        out = out.unionByName(c.counts())
    return out


@query(f"""WITH {_STOCK}, {_ITEMS}, {_BPS.split('pa AS', 1)[1].join(('pa AS', ''))},
co AS (SELECT 0 AS g, * FROM (SELECT 'materials' AS name, (SELECT count(DISTINCT MATNR) FROM ma WHERE NOT bad) AS n, (SELECT count(*) FROM ma WHERE NOT bad) AS rows
 UNION ALL SELECT 'customers', count(DISTINCT id), count(*) FROM cu WHERE NOT bad UNION ALL SELECT 'vendors', count(DISTINCT id), count(*) FROM ve WHERE NOT bad
 UNION ALL SELECT 'open_items', count(DISTINCT (BUKRS, BELNR, GJAHR, BUZEI)), count(*) FROM oi WHERE NOT bad UNION ALL SELECT 'batch_stock', count(DISTINCT (WERKS, MATNR, LGORT, CHARG)), count(*) FROM sa)),
it AS (SELECT count(*) FILTER (PARTNER <> '') AS lines FROM oi WHERE NOT bad), re AS (SELECT count(*) AS records, (SELECT count(*) FROM pg) AS n, count(DISTINCT id) AS ids FROM pb)
SELECT 'REC-CNT-' || name AS id, n || ' accepted keys' AS source_value, n || ' keys in the load file' AS target_value, rows = n AS passed, CASE WHEN rows <> n THEN (rows - n) || ' duplicate rows' ELSE '' END AS note FROM co
UNION ALL SELECT 'REC-BP-001', n || ' identities in ' || records || ' records', n || ' BPs in the load file', true, (records - n) || ' records merged into a shared BP' FROM re
UNION ALL SELECT 'REC-BP-002', CAST(lines AS STRING), CAST(lines AS STRING), true, '' FROM it UNION ALL SELECT 'REC-BP-003', CAST(records AS STRING), CAST(ids AS STRING), records = ids, '' FROM re
UNION ALL SELECT 'REC-FI-VAL-' || BUKRS || '-' || WAERS, CAST(sum(amount) AS STRING), CAST(sum(amount) AS STRING), true, '' FROM oi WHERE NOT bad GROUP BY BUKRS, WAERS
UNION ALL SELECT 'REC-FI-BAL-' || BUKRS, 'debit ' || CAST(CAST(coalesce(sum(amount) FILTER (SHKZG = 'S'), 0) AS DECIMAL(38,2)) AS STRING), 'credit ' || CAST(CAST(coalesce(sum(amount) FILTER (SHKZG <> 'S'), 0) AS DECIMAL(38,2)) AS STRING),
 coalesce(sum(amount) FILTER (SHKZG = 'S'), 0) = coalesce(sum(amount) FILTER (SHKZG <> 'S'), 0), '' FROM oi WHERE NOT bad GROUP BY BUKRS
UNION ALL SELECT 'REC-STK-' || WERKS, CAST(sum(CAST(CASE WHEN CLABS = '' THEN '0' ELSE CLABS END AS DECIMAL(38,3))) AS STRING), CAST(sum(CAST(CASE WHEN CLABS = '' THEN '0' ELSE CLABS END AS DECIMAL(38,3))) AS STRING), true, '' FROM sa GROUP BY WERKS""")
def R1_wave_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole migration, reconciled; empty quantities count as zero."""
    wave = migration.run("tables", {name: _extract(spark, sf_dir, name) for name in _EXTRACTS})
    return wave.checks.select("id", "source_value", "target_value", "passed", "note")


# --- sources and their scan ---

# Lines of which sources are made; every rule has one that breaks it and one that nearly does.
_SOURCE = (
    "REPORT zdemo.", "* SELECT * FROM mard.", "TABLES: mara, kna1.", "DATA lv_matnr TYPE c LENGTH 18.", "SELECT * FROM mard INTO TABLE lt_mard", "  WHERE matnr = lv_matnr.", "LOOP AT lt_mard INTO ls_mard.",
    "  SELECT SINGLE mblnr FROM mkpf INTO lv_doc.", "  COMMIT WORK.", "ENDLOOP.", "SELECT bukrs FROM bsid INTO lv_bukrs.", "  WRITE lv_bukrs.", "ENDSELECT.", "SELECT COUNT(*) FROM coep.", "CALL FUNCTION 'WS_UPLOAD'.", "MOVE lv_a TO lv_b.",
    "SELECT belnr FROM bkpf INTO TABLE lt_bkpf.", "UPDATE kna1 SET name1 = lv_name.", "SELECT name1 FROM lfa1 INTO TABLE lt_lfa1 CLIENT SPECIFIED.", "EXEC SQL.", "ENDEXEC.", "SELECT vbeln FROM vbuk INTO TABLE lt_vbuk.", "SELECT kunnr FROM knkk INTO TABLE lt_knkk.",
    "DO 3 TIMES.", "  SELECT charg FROM mcha INTO TABLE lt_mcha.", "ENDDO.", "SELECT dtnum FROM mdkp INTO TABLE lt_mdkp.", "SUBMIT rsnast00.", "SELECT objky FROM nast INTO TABLE lt_nast.", "DATA lt_old TYPE STANDARD TABLE WITH HEADER LINE.", "PERFORM mard_check.",
    "lv_x = lv_y(18).", "WRITE 'no mseg here'. \" mseg", "COMMIT WORK.", "SELECT-OPTIONS s_matnr FOR mara-matnr.", "WHILE lv_n > 0.", "  DELETE FROM mseg WHERE mblnr = lv_doc.", "ENDWHILE.", "", "CALL FUNCTION 'GUI_UPLOAD'.", "INSERT lfb1 FROM ls_lfb1.",
)
_INVENTORY = {
    "object_name": "'ZP' || c_custkey", "object_type": "'PROG'", "path": "CASE WHEN c_custkey % 9 = 0 THEN 'old' ELSE 'src' END || '/zp' || c_custkey || '.prog.abap'", "module": "'MM'", "owner": "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'owner' || (c_custkey % 4) END",
    "gxp_class": "CASE c_custkey % 4 WHEN 0 THEN 'gxp_critical' WHEN 1 THEN 'gxp_relevant' ELSE 'non_gxp' END", "wave": "'wave' || (c_custkey % 3)", "monthly_executions": "CAST(c_custkey * 10 AS INTEGER)", "business_criticality": "CASE WHEN c_custkey % 2 = 0 THEN 'high' ELSE 'low' END",
    "validation_package": "'VP' || c_custkey", "remediated_path": "CASE WHEN c_custkey % 7 = 0 THEN 'new/zp' || c_custkey ELSE '' END",
}
_TESTED = "c_custkey % 5 = 0"


def _scan(spark: SparkSession, sf_dir: str) -> scan.Scan:
    orders, customers = spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/customer.parquet")
    line = F.element_at(F.array(*map(F.lit, _SOURCE)), (F.col("o_orderkey") % len(_SOURCE) + 1).cast("int"))
    path = F.concat(F.lit("src/zp"), F.col("o_custkey").cast("string"), F.lit(".prog.abap"))
    rows = orders.groupBy(path.alias("path")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))).alias("all"))
    sources = rows.select("path", F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("text"))
    inventory = customers.selectExpr(*(f"{e} AS {c}" for c, e in _INVENTORY.items()), "c_custkey AS _seq")
    return scan.scan(spark, sources, inventory, customers.where(_TESTED).selectExpr("'zp' || c_custkey AS name"), store=True)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_sql(rule: tuple) -> str:
    name, _, _, _, _, tables, patterns, write_only, in_loop = rule
    found = [f"CASE WHEN regexp_matches(text, '(?i)\\b{t}\\b') THEN '{t}' END" for t in tables] + [f"nullif(trim(regexp_extract(text, {_quoted('(?i)' + p)})), '')" for p in patterns]
    tests = ([f"regexp_matches(text, {_quoted(WRITE_STATEMENT if write_only else DB_STATEMENT)})"] if tables else []) + (["loop_depth > 0"] if in_loop else [])
    return f"SELECT path, line, text, '{name}' AS rule_id, CASE WHEN {' AND '.join(tests) or 'true'} THEN coalesce({', '.join(found)}, NULL) END AS evidence FROM de"


_OPENS = f"(regexp_matches(text, {_quoted(LOOP_OPEN)}) OR (regexp_matches(text, '(?i)^SELECT([^-\\w]|$)') AND NOT regexp_matches(text, {_quoted(SET_BASED)})))"
_SHORT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_SCANNED = rf"""li AS (SELECT 'src/zp' || o_custkey || '.prog.abap' AS path, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line, [{', '.join(map(_quoted, _SOURCE))}][o_orderkey % {len(_SOURCE)} + 1] AS t FROM orders),
co AS (SELECT path, line, trim(CASE WHEN starts_with(trim(t), '*') THEN '' ELSE regexp_replace(t, '^(.*)"[^"]*$', '\1') END) AS code FROM li),
gr AS (SELECT *, coalesce(sum(CASE WHEN ends_with(code, '.') THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM co WHERE code <> ''),
sm AS (SELECT path, g, CAST(min(line) AS INTEGER) AS line, string_agg(code, ' ' ORDER BY line) AS text FROM gr GROUP BY 1, 2),
up AS (SELECT *, CASE WHEN regexp_matches(text, {_quoted(LOOP_CLOSE)}) THEN -1 WHEN {_OPENS} THEN 1 ELSE 0 END AS step FROM sm), su AS (SELECT *, sum(step) OVER (PARTITION BY path ORDER BY g) AS s FROM up),
de AS (SELECT path, line, text, s - least(0, min(s) OVER (PARTITION BY path ORDER BY g)) - CASE WHEN step = 1 THEN 1 ELSE 0 END AS loop_depth FROM su),
iv AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _INVENTORY.items())}, c_custkey % 5 = 0 AS tested FROM customer),
ob AS (SELECT p.path, upper(regexp_extract(p.path, 'src/(.*).prog.abap', 1)) AS object_name, loc, coalesce(gxp_class, 'unclassified') AS gxp_class, coalesce(wave, 'unassigned') AS wave, business_criticality, monthly_executions, validation_package, coalesce(remediated_path, '') <> '' AS fixed, coalesce(tested, false) AS tested
 FROM (SELECT path, CAST(count(*) FILTER (trim(t) <> '' AND NOT starts_with(trim(t), '*')) AS INTEGER) AS loc FROM li GROUP BY 1) p LEFT JOIN iv ON iv.path = p.path),
me(rule_id, title, category, severity, effort_points) AS (VALUES {', '.join(f"('{r[0]}', {_quoted(r[1])}, '{r[2]}', '{r[3]}', {r[4]})" for r in RULES)}),
fi AS ({' UNION ALL '.join(_rule_sql(r) for r in RULES if r[0] != OBJECT_RULE)}),
ff AS (SELECT path, line, rule_id, evidence, CASE WHEN length({_SHORT}) > 160 THEN substr({_SHORT}, 1, 157) || '...' ELSE {_SHORT} END AS statement FROM fi WHERE evidence IS NOT NULL
 UNION ALL SELECT path, 1, '{OBJECT_RULE}', gxp_class, object_name || ' (' || validation_package || ')' FROM ob WHERE gxp_class IN ('gxp_critical', 'gxp_relevant') AND NOT tested),
fm AS (SELECT path, CAST(line AS INTEGER) AS line, rule_id, evidence, statement, title, category, severity, CAST(effort_points AS INTEGER) AS effort_points FROM ff JOIN me USING (rule_id)),
pc AS (SELECT path, count(*) AS findings, CAST(sum(effort_points) AS INTEGER) AS raw_points, min(CASE severity WHEN 'blocker' THEN 0 WHEN 'critical' THEN 1 WHEN 'major' THEN 2 ELSE 3 END) AS worst, {', '.join(f"count(*) FILTER (severity = '{s}') AS {s}" for s in ('blocker', 'critical', 'major', 'minor'))} FROM fm GROUP BY 1),
oc AS (SELECT ob.*, coalesce(findings, 0) AS findings, coalesce(raw_points, 0) AS raw_points, worst, coalesce(blocker, 0) AS blocker, coalesce(critical, 0) AS critical, coalesce(major, 0) AS major, coalesce(minor, 0) AS minor,
 round_even(coalesce(raw_points, 0) * CASE gxp_class WHEN 'gxp_critical' THEN 2.0 WHEN 'gxp_relevant' THEN 1.5 ELSE 1.0 END, 1)::DOUBLE AS weighted_points FROM ob LEFT JOIN pc ON pc.path = ob.path),
bl AS (SELECT *, row_number() OVER (ORDER BY CASE wave WHEN 'wave0' THEN 0 WHEN 'wave1' THEN 1 WHEN 'wave2' THEN 2 ELSE 9 END, worst, CASE WHEN business_criticality = 'high' THEN -2 ELSE 0 END, -coalesce(monthly_executions, 0), object_name) AS position FROM oc WHERE findings > 0 AND NOT fixed)"""


@query(f"WITH {_SCANNED} SELECT path, line, rule_id, evidence, statement, title, category, severity, effort_points FROM fm")
def P16_scan_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all rules, with their metadata."""
    return _scan(spark, sf_dir).findings.select("path", "line", "rule_id", "evidence", "statement", "title", "category", "severity", "effort_points")


@query(f"WITH {_SCANNED} SELECT path, object_name, wave, gxp_class, loc, findings, raw_points, weighted_points, blocker, critical, major, minor FROM oc")
def P16_scan_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).objects.select("path", "object_name", "wave", "gxp_class", "loc", "findings", "raw_points", "weighted_points", "blocker", "critical", "major", "minor")


@query(f"WITH {_SCANNED} SELECT rule_id, count(*) AS n, count(DISTINCT path) AS objects FROM fm GROUP BY 1")
def P16_findings_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the rules finds something in these sources."""
    return _scan(spark, sf_dir).findings.groupBy("rule_id").agg(F.count("*").alias("n"), F.count_distinct("path").alias("objects"))


@query(f"WITH {_SCANNED} SELECT fm.path, fm.line, fm.rule_id, CAST(row_number() OVER (ORDER BY position, fm.line, fm.rule_id) AS INTEGER) AS place FROM fm JOIN bl ON bl.path = fm.path")
def P12_finding_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outstanding findings in the order of the report: objects by priority, then lines, then rules."""
    found = _scan(spark, sf_dir)
    rows = found.findings.join(found.backlog().select("path", "position"), "path").select("path", "line", "rule_id", F.struct("position", "line", "rule_id").alias("order"))
    return mapping.numbered(rows, "order", 1, "place").select("path", "line", "rule_id", F.col("place").cast("int").alias("place"))


@query(f"WITH {_SCANNED} SELECT wave, count(*) AS objects, CAST(sum(findings) AS BIGINT) AS findings, round_even(sum(weighted_points) / 7.5, 1) AS engineer_days FROM bl GROUP BY 1")
def B6_count_by_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.by_wave(_scan(spark, sf_dir).backlog())


@query(f"WITH {_SCANNED} SELECT fm.path, fm.line, fm.rule_id FROM fm JOIN oc ON oc.path = fm.path WHERE wave = 'wave1'")
def B12_wave_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).wave("wave1").findings.select("path", "line", "rule_id")


@query(f"WITH {_SCANNED} SELECT path, line, rule_id, evidence, statement FROM ff WHERE rule_id = '{OBJECT_RULE}'")
def F14_test_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of a validated class without test evidence."""
    return _scan(spark, sf_dir).findings.where(F.col("rule_id") == rules.OBJECT_RULE).select("path", "line", "rule_id", "evidence", "statement")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'owner' || (o_custkey % 4) END AS owner FROM orders")
def P15_for_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory entries by name, whatever its case."""
    inventory = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*(f"{e} AS {c}" for c, e in _INVENTORY.items()), "c_custkey AS _seq")
    names = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN 'Zp' ELSE 'zP' END || o_custkey AS name")
    return names.join(rules.for_name(names.select("name").distinct(), inventory), "name", "left").select("o_orderkey", "owner")


@query(f"WITH {_SCANNED} SELECT DISTINCT wave FROM iv")
def P15_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*(f"{e} AS {c}" for c, e in _INVENTORY.items()), "c_custkey AS _seq")
    return rules.waves(inventory)


@query(f"WITH {_SCANNED} SELECT threshold, count(path) > 0 AS found FROM (VALUES ('blocker', 0), ('critical', 1), ('major', 2), ('minor', 3)) AS t(threshold, place) LEFT JOIN (SELECT fm.path, severity FROM fm JOIN bl ON bl.path = fm.path) f ON CASE severity WHEN 'blocker' THEN 0 WHEN 'critical' THEN 1 WHEN 'major' THEN 2 ELSE 3 END <= place GROUP BY 1")
def B14_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether outstanding findings reach each threshold."""
    found = stored(_scan(spark, sf_dir).outstanding_findings().select("severity"), "severities")
    return union([backlog.reaches(found, s).select(F.lit(s).alias("threshold"), "found") for s in SEVERITIES])


@query(f"WITH {_STOCK}, {_ITEMS} SELECT bool_and(p) AS passed, count(*) FILTER (NOT p) AS failed, count(*) AS total FROM (SELECT coalesce(sum(amount) FILTER (SHKZG = 'S'), 0) = coalesce(sum(amount) FILTER (SHKZG <> 'S'), 0) AS p FROM oi WHERE NOT bad GROUP BY BUKRS)")
def R8_balance_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = mapping.map_open_items(_items(spark, sf_dir).accepted, _business_partners(spark, sf_dir).lookup())
    return reconcile.verdict(reconcile.balance_checks(items))
