"""The source scan: files to statements to findings to a backlog."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import backlog, rules, statements
from ledgerloom.operators.issues import union
from ledgerloom.sources import read_sources, read_test_names
from ledgerloom.sources.shared import stored


@dataclass
class Scan:
    objects: DataFrame  # one row a file, with inventory columns, lines of code and counts
    findings: DataFrame  # with the metadata of their rules

    def backlog(self) -> DataFrame:
        return backlog.with_position(backlog.outstanding(self.objects))

    def outstanding_findings(self) -> DataFrame:
        return self.findings.join(self.backlog().select("path"), "path", "left_semi")

    def held(self) -> Scan:
        """The same, computed once for all parts of a report. What is lost is computed again, with the same rows."""
        findings = self.findings.persist()  # first, as objects are made of them
        return Scan(self.objects.persist(), findings)

    def release(self) -> None:
        self.objects.unpersist()
        self.findings.unpersist()

    def wave(self, name: str) -> Scan:
        keep = self.objects.where(F.col("wave") == name)
        return Scan(keep, self.findings.join(keep.select("path"), "path", "left_semi"))


def scan(spark: SparkSession, sources: DataFrame, inventory: DataFrame | None = None, tests: DataFrame | None = None, include: Iterable[str] = (), exclude: Iterable[str] = (), store: bool = False) -> Scan:
    """sources: (path, text). tests: (name) of objects with test evidence. store: write sources and findings to the folder that the cluster shares, where objects and findings are both read, so that sources are made once and statements searched once."""
    chosen = rules.selected(include, exclude)
    sources = sources.select("path", "text", F.when(F.col("text").isNotNull(), statements.effective_count(F.col("text"))).alias("loc"))
    if store:
        sources = stored(sources, "sources")
    stmts = statements.of_texts(sources)
    found = rules.findings(stmts, [r for r in chosen if r.id != rules.OBJECT_RULE])
    loc = sources.groupBy("path").agg(F.sum("loc").cast("int").alias("loc"))
    objects = sources.select("path").join(loc, "path", "left").withColumn("loc", F.coalesce("loc", F.lit(0))).withColumn("object_name", rules.object_name(F.col("path")))
    if inventory is None:
        inventory = spark.createDataFrame([], "object_name string, object_type string, path string, module string, owner string, gxp_class string, wave string, monthly_executions int, business_criticality string, validation_package string, remediated_path string, _seq int")
    entries = rules.with_inventory(sources.select("path"), inventory).drop("object_name")
    objects = objects.join(entries, "path", "left").withColumns({"wave": F.coalesce("wave", F.lit("unassigned")), "gxp_class": F.coalesce("gxp_class", F.lit("unclassified"))})
    if rules.OBJECT_RULE in {r.id for r in chosen}:
        names = tests if tests is not None else spark.createDataFrame([], "name string")
        found = union([found, rules.object_findings(objects, names)])
    found = rules.with_metadata(stored(found, "findings") if store else found, spark)
    return Scan(backlog.per_object(objects, found), found)


def scan_paths(spark: SparkSession, roots: list[str], inventory: DataFrame | None = None, test_roots: list[str] | None = None, **options) -> Scan:  # noqa: ANN003
    """Scan files below roots; test evidence below test_roots, by default the roots."""
    sources = union([read_sources(spark, r) for r in roots])
    tests = union([read_test_names(spark, r) for r in (test_roots or roots)])
    return scan(spark, sources, inventory, tests, **options)
