"""Data-quality rules of the five objects of a wave.

A fix changes the value that later rules and all outputs see; where a rule looks at the value before its fix, the predicate says so by
the raw column. Fixed values throughout: rule ids, actions, fields and messages, which readers of the exception files depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.constants import ISO_COUNTRIES, UOM_ISO, VAT_COUNTRIES
from ledgerloom.functions import left_join, money
from ledgerloom.operators.issues import FIX, REJECT, WARN, Cleansed, RowRule, annotate, duplicates, issues_of, union


def _columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != "_seq"]


def not_upper(c: Column) -> Column:
    return (c != "") & (c != F.upper(c))


def cleanse_materials(rows: DataFrame) -> Cleansed:
    raw = rows.withColumns({"_unit": F.col("MEINS"), "_weight": F.col("BRGEW"), "_text": F.col("MAKTX")})
    raw = raw.withColumns({"MEINS": F.upper("MEINS"), "BRGEW": F.when(F.col("BRGEW") == "", "0.000").otherwise(F.col("BRGEW")), "MAKTX": F.upper("MAKTX")})
    unit, weight, text, fixed = F.col("_unit"), F.col("_weight"), F.col("_text"), F.col("MEINS")
    rules = [
        RowRule("DQ-MAT-001", FIX, "MEINS", not_upper(unit), F.concat(F.lit("base unit '"), unit, F.lit("' upper-cased"))),
        RowRule("DQ-MAT-002", REJECT, "MEINS", fixed == "", "base unit of measure is missing"),
        RowRule("DQ-MAT-003", REJECT, "MEINS", (fixed != "") & ~fixed.isin(*UOM_ISO), F.concat(F.lit("no ISO mapping for base unit '"), fixed, F.lit("'"))),
        RowRule("DQ-MAT-004", REJECT, "GEWEI", (weight != "") & (F.col("GEWEI") == ""), "gross weight supplied without a weight unit"),
        RowRule("DQ-MAT-005", WARN, "BRGEW", weight == "", "gross weight is missing, loaded as zero"),
        RowRule("DQ-MAT-006", REJECT, "MHDHB", (F.col("XCHPF") == "X") & (F.col("MHDHB") == ""), "batch managed material without total shelf life (GMP)"),
        RowRule("DQ-MAT-007", FIX, "MAKTX", not_upper(text), "description normalised to upper case"),
    ]
    done = annotate(raw, "materials", F.col("MATNR"), rules)
    twice = duplicates(done, "materials", "DQ-MAT-008", [F.col("MAKTX")], "MATNR", "MAKTX", lambda g: F.concat(F.lit("duplicate material description '"), g, F.lit("'")))
    return Cleansed("materials", done, _columns(rows), twice, found=issues_of("materials", F.col("MATNR"), rules))


def identity(rows: DataFrame) -> list[Column]:
    """Name, country, postal code and VAT registration in upper case: what makes two records one party."""
    vat = F.col("STCEG") if "STCEG" in rows.columns else F.lit("")
    return [F.upper(c) for c in (F.col("NAME1"), F.col("LAND1"), F.col("PSTLZ"), vat)]


def cleanse_partners(rows: DataFrame, object_name: str, key: str) -> Cleansed:
    prefix = "DQ-CUS" if object_name == "customers" else "DQ-VEN"
    raw = rows.withColumn("_country", F.col("LAND1")).withColumn("LAND1", F.upper("LAND1"))
    country = F.col("LAND1")
    nameless = (F.col("NAME1") == "") | (country == "")
    vat = F.col("STCEG") if "STCEG" in rows.columns else F.lit("")
    rules = [
        RowRule(f"{prefix}-001", FIX, "LAND1", not_upper(F.col("_country")), F.concat(F.lit("country '"), F.col("_country"), F.lit("' upper-cased"))),
        RowRule(f"{prefix}-002", REJECT, "NAME1", nameless, "name or country missing, cannot create a business partner"),
        RowRule(f"{prefix}-003", REJECT, "LAND1", ~nameless & ~country.isin(*ISO_COUNTRIES), F.concat(F.lit("'"), country, F.lit("' is not a valid ISO country code"))),
        RowRule(f"{prefix}-004", WARN, "PSTLZ", F.col("PSTLZ") == "", "postal code missing, address will not be validated"),
        RowRule(f"{prefix}-005", WARN, "STCEG", (vat == "") & country.isin(*VAT_COUNTRIES), "VAT registration missing for an EU/UK partner"),
    ]
    if object_name == "vendors":
        audited = F.col("ZZ_GMP_AUDITED") == "X" if "ZZ_GMP_AUDITED" in rows.columns else F.lit(False)
        rules.append(RowRule("DQ-VEN-006", WARN, "ZZ_GMP_AUDITED", ~audited, "supplier has no GMP audit flag, confirm before cutover"))
    done = annotate(raw, object_name, F.col(key), rules)
    merged = duplicates(done.where(~F.col("_reject")), object_name, f"{prefix}-007", identity(rows), key, "NAME1", lambda g: F.concat(F.lit("records merge into one business partner: "), g))
    return Cleansed(object_name, done, _columns(rows), merged, found=issues_of(object_name, F.col(key), rules))


def document_totals(lines: DataFrame, keys: list[str], side: Column, amount: Column, more: tuple[Column, ...] = ()) -> DataFrame:
    """Debit (S) and credit (H) of each document, its first row, and more aggregates; other sides count for neither."""
    total = lambda s: F.coalesce(F.sum(F.when(side == s, amount)), F.lit(0)).cast("decimal(38,2)")
    return lines.groupBy(*keys).agg(total("S").alias("_debit"), total("H").alias("_credit"), F.min("_seq").alias("_first"), *more)


def cleanse_open_items(rows: DataFrame, partners: DataFrame, partner_key: str = "partner") -> Cleansed:
    """partners: accepted ids. A document that does not balance, or names an unknown partner, is rejected as a whole. Documents come out in the order of their first lines.

    Totals are aggregated and joined back, so a document of very many lines is combined before the shuffle and its join can be split.
    """
    doc = ["BUKRS", "BELNR", "GJAHR"]
    known = partners.select(F.col(partner_key).alias("PARTNER")).distinct().withColumn("_known", F.lit(True))
    lines = left_join(rows, "PARTNER", known).withColumn("_unknown", (F.col("PARTNER") != "") & F.col("_known").isNull())
    totals = document_totals(lines, doc, F.col("SHKZG"), money(F.col("DMBTR"), 2), (F.count_if("_unknown").alias("_bad"),))
    lines = lines.join(totals, doc).select(*_columns(rows), "_seq", "_debit", "_credit", "_first", "_unknown", "_bad")
    off = F.col("_debit") != F.col("_credit")
    lines = lines.withColumn("_doc", F.concat_ws("/", *doc))
    text = F.concat(F.lit("document does not balance: debit "), F.col("_debit").cast("string"), F.lit(" credit "), F.col("_credit").cast("string"))
    rules = [
        RowRule("DQ-FI-001", REJECT, "DMBTR", off & (F.col("_seq") == F.col("_first")), text),
        RowRule("DQ-FI-002", REJECT, "PARTNER", F.col("_unknown"), F.concat(F.lit("partner "), F.col("PARTNER"), F.lit(" is not in the migrated master data"))),
        RowRule("DQ-FI-003", WARN, "ZFBDT", (F.col("PARTNER") != "") & (F.col("ZFBDT") == ""), "open item has no baseline date, ageing will be wrong"),
    ]
    done = annotate(lines, "open_items", F.col("_doc"), rules).withColumn("_reject", off | (F.col("_bad") > 0))
    return Cleansed("open_items", done, _columns(rows), order=["_first", "_seq"], found=issues_of("open_items", F.col("_doc"), rules))


def cleanse_batch_stock(rows: DataFrame, materials: DataFrame) -> Cleansed:
    """materials: accepted materials, one row a number (see mapping.material_dimension)."""
    managed = F.col("XCHPF") if "XCHPF" in materials.columns else F.lit("")
    dim = materials.select("MATNR", F.col("MEINS").alias("_mat_unit"), managed.alias("_mat_batch"), F.lit(True).alias("_found"))
    joined = rows.join(dim, "MATNR", "left").withColumn("_found", F.coalesce("_found", F.lit(False)))
    found, batch = F.col("_found"), F.coalesce(F.col("_mat_batch") == "X", F.lit(False))
    unit = F.concat(F.lit("stock is in '"), F.col("MEINS"), F.lit("' but the material master says '"), F.col("_mat_unit"), F.lit("', so the quantity cannot be loaded without a unit decision"))
    inspection = F.when(F.col("CINSM") == "", 0.0).otherwise(F.col("CINSM").cast("double")) > 0
    rules = [
        RowRule("DQ-STK-001", REJECT, "MATNR", ~found, "stock for a material that is not in the migrated master"),
        RowRule("DQ-STK-002", REJECT, "CHARG", found & ~batch, "batch stock for a material that is not batch managed"),
        RowRule("DQ-STK-005", REJECT, "MEINS", found & (F.col("_mat_unit") != F.col("MEINS")), unit),
        RowRule("DQ-STK-003", WARN, "VFDAT", found & batch & (F.col("VFDAT") == ""), "batch has no expiry date"),
        RowRule("DQ-STK-004", WARN, "CINSM", inspection, "stock in quality inspection at cutover, needs a usage decision before go-live"),
    ]
    key = F.concat_ws("/", "WERKS", "MATNR", "CHARG")
    done = annotate(joined.select(*_columns(rows), "_seq", "_mat_unit", "_mat_batch", "_found"), "batch_stock", key, rules)
    return Cleansed("batch_stock", done, _columns(rows), found=issues_of("batch_stock", key, rules))


__all__ = ["cleanse_batch_stock", "cleanse_materials", "cleanse_open_items", "cleanse_partners", "document_totals", "identity", "union"]
