"""Findings to a prioritised, effort-weighted backlog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.constants import CRITICALITY, GXP_MULTIPLIER, HOURS_PER_DAY, LAST_WAVE, SEVERITIES, WAVE_ORDER
from ledgerloom.functions import lookup
from ledgerloom.operators.rules import rank


def weighted(raw: Column, gxp_class: Column) -> Column:
    """Points times the class's multiplier, rounded by object."""
    return F.bround(raw * lookup(gxp_class, GXP_MULTIPLIER, F.lit(1.0)), 1)


def per_object(objects: DataFrame, findings: DataFrame, key: str = "path", carried: Sequence[str] = ()) -> DataFrame:
    """Objects with counts by severity, the worst rank, raw and weighted points. findings: key, severity, effort_points.

    carried: columns of findings that each object keeps in ``found``, an array, so that what follows need not find them again.
    """
    found = [F.collect_list(F.struct(*carried)).alias("found")] if carried else []
    counts = findings.groupBy(key).agg(*found, F.count("*").alias("findings"), F.sum("effort_points").cast("int").alias("raw_points"), F.min(rank(F.col("severity"))).alias("worst"), *(F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("findings", "raw_points", *SEVERITIES)}
    rows = objects.join(counts, key, "left").withColumns(zero)
    return rows.withColumn("weighted_points", weighted(F.col("raw_points"), F.col("gxp_class")))


def _remediated() -> Column:
    return F.coalesce(F.col("remediated_path") != "", F.lit(False))


def outstanding(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("findings") > 0) & ~_remediated())


def remediated(rows: DataFrame) -> DataFrame:
    return rows.where(_remediated())


def priority() -> list[Column]:
    wave = lookup(F.col("wave"), WAVE_ORDER, F.lit(LAST_WAVE))
    return [wave, F.coalesce("worst", F.lit(99)), -lookup(F.col("business_criticality"), CRITICALITY, F.lit(0)), -F.coalesce("monthly_executions", F.lit(0)), F.col("object_name")]


def with_position(rows: DataFrame) -> DataFrame:
    """Adds the sort key of the backlog as one struct, a total order without numbering."""
    return rows.withColumn("position", F.struct(*(c.alias(f"p{i}") for i, c in enumerate(priority()))))


def effort(rows: DataFrame) -> DataFrame:
    """One row: raw, weighted, days, overhead days."""
    raw, w = F.coalesce(F.sum("raw_points"), F.lit(0)), F.coalesce(F.sum("weighted_points"), F.lit(0.0))
    return rows.agg(raw.alias("raw_points"), F.bround(w, 1).alias("weighted_points"), F.bround(w / HOURS_PER_DAY, 1).alias("engineer_days"), F.bround((w - raw) / HOURS_PER_DAY, 1).alias("validation_overhead_days"))


def by_wave(rows: DataFrame) -> DataFrame:
    return rows.groupBy("wave").agg(F.count("*").alias("objects"), F.sum("findings").alias("findings"), F.bround(F.sum("weighted_points") / HOURS_PER_DAY, 1).alias("engineer_days"))


def by_rule(rows: DataFrame) -> DataFrame:
    """(rule_id, n, first): counts of rules over the backlog, ties by where a rule first appears in it. rows: position and found, with line and rule_id."""
    placed = rows.select("position", F.explode("found").alias("f"))
    return placed.groupBy(F.col("f.rule_id").alias("rule_id")).agg(F.count("*").alias("n"), F.min(F.struct("position", "f.line", "f.rule_id")).alias("first"))


def first_per_rule(rows: DataFrame, key: str = "path") -> DataFrame:
    """The first finding of each rule, in backlog order. rows: key, position and found, with line and rule_id."""
    placed = rows.select(key, "position", F.explode("found").alias("f"))
    place = F.struct("position", "f.line")
    return placed.groupBy(F.col("f.rule_id").alias("_rule")).agg(F.min(place).alias("first"), F.min_by(F.struct(key, "f"), place).alias("x")).select("first", f"x.{key}", "x.f.*")


def reaches(findings: DataFrame, threshold: str) -> DataFrame:
    """One row, found: whether any finding is as severe as the threshold. The search ends at the first."""
    return findings.where(rank(F.col("severity")) <= SEVERITIES.index(threshold)).limit(1).agg((F.count("*") > 0).alias("found"))
