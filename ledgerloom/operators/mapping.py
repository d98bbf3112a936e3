"""Accepted records to the target model: products, business partners with their cross reference, open items, stock."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ledgerloom.constants import CUSTOMER_ROLES, FIRST_PARTNER, PARTNER_GROUPING, PRODUCT_TYPES, UOM_ISO, VENDOR_ROLES
from ledgerloom.functions import flag, left_join, lookup, strip_zeros
from ledgerloom.operators.quality import identity
from ledgerloom.sources.shared import available, stored


def map_materials(rows: DataFrame) -> DataFrame:
    return rows.select(
        strip_zeros(F.col("MATNR")).alias("Product"), lookup(F.col("MTART"), PRODUCT_TYPES, F.col("MTART")).alias("ProductType"), F.col("MATKL").alias("ProductGroup"),
        lookup(F.col("MEINS"), UOM_ISO).alias("BaseUnit"), F.col("BRGEW").alias("GrossWeight"), lookup(F.col("GEWEI"), UOM_ISO, F.col("GEWEI")).alias("WeightUnit"),
        F.col("SPART").alias("Division"), flag(F.col("XCHPF")).alias("BatchManagement"), F.col("MHDHB").alias("ShelfLifeDays"), F.col("ZZ_TEMP_CLASS").alias("StorageConditionClass"),
        F.col("MAKTX").alias("ProductDescription"), F.col("WERKS").alias("Plant"), F.col("DISPO").alias("MRPController"), "_seq")


def material_dimension(materials: DataFrame) -> DataFrame:
    """One row a number: the last of its rows."""
    columns = [c for c in materials.columns if c not in ("MATNR", "_seq")]
    return materials.groupBy("MATNR").agg(F.max_by(F.struct(*columns), F.col("_seq")).alias("m")).select("MATNR", "m.*")


def entities(records: DataFrame, group: list[Column], order: Column, first: dict[str, Column], lists: dict[str, Column], sets: dict[str, Column]) -> DataFrame:
    """One row a distinct group: its first order, attributes of its first record, lists in order, sorted sets.

    Everything combines before the shuffle but the lists, which are the output itself.
    """
    names = [f"_g{i}" for i in range(len(group))]
    rows = records.select(*(g.alias(n) for g, n in zip(group, names, strict=True)), order.alias("_order"), *(c.alias(f"_f_{n}") for n, c in first.items()),
                          *(c.alias(f"_l_{n}") for n, c in lists.items()), *(c.alias(f"_s_{n}") for n, c in sets.items()))
    in_order = lambda n: F.transform(F.array_sort(F.collect_list(F.when(F.col(f"_l_{n}").isNotNull(), F.struct("_order", F.col(f"_l_{n}").alias("v"))))), lambda x: x["v"])
    sets_of = lambda n: F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"_s_{n}"))))
    return rows.groupBy(*names).agg(F.min("_order").alias("_first"), *(F.min_by(f"_f_{n}", "_order").alias(n) for n in first), *(in_order(n).alias(n) for n in lists), *(sets_of(n).alias(n) for n in sets))


def literal(value: object, kind: DataType) -> Column:
    """A collected value as a constant of its type."""
    if isinstance(kind, StructType):
        return F.struct(*(literal(None if value is None else value[f.name], f.dataType).alias(f.name) for f in kind.fields))
    return F.lit(value).cast(kind)


def _rank(key: Column, bounds: list[Column]) -> Column:
    """How many of the sorted bounds lie below the key: first among every so many of them, then among those between."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    below = lambda some: F.size(F.filter(some, lambda b: b < key))
    coarse = below(F.array(*(g[-1] for g in groups)))
    return coarse * width + F.when(coarse < len(groups), below(F.element_at(F.array(*(F.array(*g) for g in groups)), coarse + 1))).otherwise(len(bounds) - len(groups) * width)


def numbered(rows: DataFrame, order: str, start: int, name: str, parts: int | None = None) -> DataFrame:
    """Consecutive numbers in the order of a column without nulls, without one task for all rows.

    Spark deals the keys alone into ranges once; the largest key and the number of rows of each range come back, ``parts`` rows at most. From then on they are constants of the plan: a row's range follows from its key, and what
    lies ahead of it from the counts. So a task that runs again, after an executor is lost, gives the numbers that it gave before. Rows of equal keys are numbered in any order.
    Where there is a shared folder the rows are stored as they come, so that they are computed once, and then by range with their place in it. They are shuffled once, and no key is compared with the ranges' bounds.
    """
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if available(rows.sparkSession):
        dealt = stored(rows, "numbered").repartitionByRange(n, order).sortWithinPartitions(order)
        dealt = stored(dealt.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ranges")
        sizes, before = dict(dealt.groupBy("_range").agg(F.count("*")).collect()), []
        for i in range(max(sizes, default=0) + 1):
            before.append(before[-1] + sizes.get(i - 1, 0) if before else start)
        return dealt.withColumn(name, (F.col("_place") + 1 + F.element_at(F.array(*(F.lit(b - 1).cast("long") for b in before)), F.col("_range") + 1))).drop("_range", "_place")
    ranges = rows.select(F.col(order).alias("k")).repartitionByRange(n, "k").groupBy(F.spark_partition_id()).agg(F.max("k").alias("top"), F.count("*").alias("n")).orderBy("top").collect()
    kind, ahead = rows.schema[order].dataType, [0]
    for r in ranges:
        ahead.append(ahead[-1] + r["n"])
    rows = rows.withColumn("_range", _rank(F.col(order), [literal(r["top"], kind) for r in ranges[:-1]]))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return rows.withColumn(name, place + F.element_at(F.array(*map(F.lit, ahead)), F.col("_range") + 1) + (start - 1)).drop("_range")


@dataclass
class Partners:
    """Business partners and which source ids they came from."""

    partners: DataFrame
    xref: DataFrame

    def lookup(self) -> DataFrame:
        """(id, bp): one namespace for customers and vendors, in which vendors win."""
        side = F.when(F.col("SourceType") == "LFA1", 1).otherwise(0)
        return self.xref.groupBy(F.col("SourceId").alias("id")).agg(F.max_by("BusinessPartner", F.struct(side.alias("s"), "_order")).alias("bp"))

    def merged_count(self) -> DataFrame:
        return self.xref.agg((F.count("*") - F.count_distinct("BusinessPartner")).alias("merged"))


def business_partners(customers: DataFrame, vendors: DataFrame) -> Partners:
    """Customers, then vendors, folded by identity. Numbers follow first appearance."""

    def side(rows: DataFrame, key: str, i: int, kind: str, roles: tuple[str, ...]) -> DataFrame:
        ids = identity(rows)
        text = lambda c: F.col(c) if c in rows.columns else F.lit("")
        return rows.select(*(c.alias(f"i{n}") for n, c in enumerate(ids)), F.struct(F.lit(i).alias("side"), "_seq").alias("order"), F.col(key).alias("id"), F.lit(kind).alias("kind"), F.array(*map(F.lit, roles)).alias("roles"),
                           *(text(c).alias(c) for c in ("NAME1", "LAND1", "ORT01", "PSTLZ", "STRAS", "STCEG", "BUKRS")))

    both = side(customers, "KUNNR", 0, "KNA1", CUSTOMER_ROLES).unionByName(side(vendors, "LFA1" if "LFA1" in vendors.columns else "LIFNR", 1, "LFA1", VENDOR_ROLES))
    group = [F.col(f"i{n}") for n in range(4)]
    found = entities(both, group, F.col("order"), {c: F.col(c) for c in ("NAME1", "LAND1", "ORT01", "PSTLZ", "STRAS", "STCEG")},
                     {"customers": F.when(F.col("kind") == "KNA1", F.col("id")), "vendors": F.when(F.col("kind") == "LFA1", F.col("id"))}, {"roles": F.col("roles"), "codes": F.array("BUKRS")})
    done = numbered(found, "_first", FIRST_PARTNER, "_bp").withColumn("BusinessPartner", F.col("_bp").cast("string"))
    rows = done.select("BusinessPartner", F.lit(PARTNER_GROUPING).alias("BusinessPartnerGrouping"), F.col("NAME1").alias("BusinessPartnerName"), F.col("LAND1").alias("Country"), F.col("ORT01").alias("CityName"),
                       F.col("PSTLZ").alias("PostalCode"), F.col("STRAS").alias("StreetName"), F.col("STCEG").alias("VATRegistration"), F.array_join("roles", ";").alias("BusinessPartnerRoles"),
                       F.array_join("codes", ";").alias("CompanyCodes"), F.array_join("customers", ";").alias("SourceCustomers"), F.array_join("vendors", ";").alias("SourceVendors"), F.col("_bp").alias("_seq"))
    names = done.select(*(F.col(f"_g{n}").alias(f"i{n}") for n in range(4)), "BusinessPartner")
    xref = both.join(names, [f"i{n}" for n in range(4)]).select(F.col("kind").alias("SourceType"), F.col("id").alias("SourceId"), "BusinessPartner", F.col("order").alias("_order"), F.struct("kind", "id", "order").alias("_seq"))
    return Partners(rows, xref)


def map_open_items(rows: DataFrame, xref: DataFrame) -> DataFrame:
    """xref: (id, bp), see Partners.lookup."""
    found = left_join(rows, "PARTNER", xref.withColumnRenamed("id", "PARTNER"))
    return found.select(
        F.col("BUKRS").alias("CompanyCode"), F.col("BELNR").alias("AccountingDocument"), F.col("GJAHR").alias("FiscalYear"), F.col("BUZEI").alias("AccountingDocumentItem"), F.col("BLART").alias("AccountingDocumentType"),
        F.col("HKONT").alias("GLAccount"), F.coalesce("bp", F.lit("")).alias("BusinessPartner"), F.col("PARTNER").alias("SourcePartner"), F.col("SHKZG").alias("DebitCreditCode"), F.col("DMBTR").alias("AmountInCompanyCodeCurrency"),
        F.col("WAERS").alias("CompanyCodeCurrency"), F.col("BUDAT").alias("PostingDate"), F.col("ZFBDT").alias("NetDueDate"), *(c for c in ("_first", "_seq") if c in rows.columns))


def map_stock(rows: DataFrame, materials: DataFrame) -> DataFrame:
    """materials: see material_dimension. The unit is the material's, if it has one."""
    dim = materials.select("MATNR", F.col("MEINS").alias("_unit"), F.col("ZZ_TEMP_CLASS").alias("_class") if "ZZ_TEMP_CLASS" in materials.columns else F.lit("").alias("_class"))
    found = rows.join(dim, "MATNR", "left")
    unit = F.coalesce(F.nullif(F.col("_unit"), F.lit("")), F.col("MEINS"))
    return found.select(
        strip_zeros(F.col("MATNR")).alias("Product"), F.col("WERKS").alias("Plant"), F.col("LGORT").alias("StorageLocation"), F.col("CHARG").alias("Batch"), F.col("CLABS").alias("UnrestrictedQuantity"),
        F.col("CINSM").alias("QualityInspectionQuantity"), F.col("CSPEM").alias("BlockedQuantity"), lookup(unit, UOM_ISO, unit).alias("BaseUnit"), F.col("VFDAT").alias("ShelfLifeExpirationDate"), F.col("HSDAT").alias("ManufactureDate"),
        F.col("ZUSTD").alias("BatchStatus"), F.coalesce("_class", F.lit("")).alias("StorageConditionClass"), "_seq")


def key_of(*columns: str | Column) -> Column:
    return F.concat_ws("/", *columns)
