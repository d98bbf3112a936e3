"""Data-quality rules as data: each is a predicate and a message; one projection evaluates all of them.

A row gets ``_issues`` (in rule order) and ``_reject``. Rules of groups come from aggregations and follow the row issues.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.shared import PLACE, stored_in_order

FIX, WARN, REJECT = "fix", "warn", "reject"
FIELDS = ("rule_id", "action", "object", "key", "field", "message")
TYPE = "array<struct<rule_id:string,action:string,object:string,key:string,field:string,message:string>>"


@dataclass(frozen=True)
class RowRule:
    rule_id: str
    action: str
    field: str
    when: Column
    message: Column | str

    def issue(self, object_name: str, key: Column) -> Column:
        message = F.lit(self.message) if isinstance(self.message, str) else self.message
        values = (F.lit(self.rule_id), F.lit(self.action), F.lit(object_name), key, F.lit(self.field), message)
        return F.when(self.when, F.struct(*(v.cast("string").alias(n) for v, n in zip(values, FIELDS, strict=True))))


def issues_of(object_name: str, key: Column, rules: list[RowRule]) -> Column:
    return F.filter(F.array(*(r.issue(object_name, key) for r in rules)), lambda x: x.isNotNull()) if rules else F.array().cast(TYPE)


def annotate(rows: DataFrame, object_name: str, key: Column, rules: list[RowRule]) -> DataFrame:
    return rows.withColumn("_issues", issues_of(object_name, key, rules)).withColumn("_reject", F.exists("_issues", lambda x: x["action"] == REJECT))


@dataclass
class Cleansed:
    """An annotated input and how it splits. ``columns`` are those of the extract; ``group_issues`` follow the row issues. ``found`` makes the row issues from the other columns, so they need not be stored."""

    object: str
    annotated: DataFrame
    columns: list[str]
    group_issues: DataFrame | None = None
    order: list[str] = field(default_factory=lambda: ["_seq"])
    found: Column | None = None

    def store(self) -> None:
        """Compute the annotated rows once, in their order, without the issues' texts."""
        rows = stored_in_order(self.annotated.drop("_issues"), "annotated", self.order)
        self.annotated = rows.withColumn("_issues", self.found)
        self.annotated.stored_at = rows.stored_at

    @property
    def _place(self) -> list[str]:
        return [c for c in PLACE if c in self.annotated.columns]

    @property
    def accepted(self) -> DataFrame:
        return self.annotated.where(~F.col("_reject")).select(*self.columns, "_seq", *(c for c in self.order if c != "_seq"))

    @property
    def rejected(self) -> DataFrame:
        return self.annotated.where("_reject").select(*self.columns, "_seq", *(c for c in self.order if c != "_seq"), *self._place)

    @property
    def issues(self) -> DataFrame:
        """All issues with _stage, _at and _pos, by which they sort in the order they arise."""
        return union([rows.drop(*PLACE) for rows in self.issues_by_stage])

    @property
    def issues_by_stage(self) -> list[DataFrame]:
        """Issues of rows, with the place of their rows if these are stored, then those of groups."""
        at = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)))
        rows = self.annotated.select(F.lit(0).alias("_stage"), at.alias("_at"), *self._place, F.posexplode("_issues").alias("_pos", "i")).select("i.*", "_stage", "_at", "_pos", *self._place)
        if self.group_issues is None:
            return [rows]
        empty = F.struct(*(F.col("_seq").alias(f"o{i}") for i in range(len(self.order))))
        return [rows, self.group_issues.select(*FIELDS, F.lit(1).alias("_stage"), empty.alias("_at"), F.lit(0).alias("_pos"))]

    def issues_for(self, rule_id: str) -> DataFrame:
        return self.issues.where(F.col("rule_id") == rule_id)

    def counts(self) -> DataFrame:
        """One row: object, extracted, rejected, loaded, and fix, warn, reject issues, zeros included."""
        total = self.annotated.agg(F.count("*").alias("extracted"), F.count_if("_reject").alias("rejected"))
        actions = self.issues.agg(*(F.count_if(F.col("action") == a).alias(a) for a in (FIX, WARN, REJECT)))
        return total.crossJoin(actions).select(F.lit(self.object).alias("object"), "extracted", "rejected", (F.col("extracted") - F.col("rejected")).alias("loaded"), FIX, WARN, REJECT)  # one row each


def counts_by_action(issues: DataFrame) -> DataFrame:
    """(action, n) for all three actions, zeros included."""
    one = issues.agg(*(F.count_if(F.col("action") == a).alias(a) for a in (FIX, WARN, REJECT)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(a).alias("action"), F.col(a).alias("n")) for a in (FIX, WARN, REJECT)))).alias("x")).select("x.*")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Rows of a group whose keys are put together at a time.
CHUNK = 1024


def duplicates(rows: DataFrame, object_name: str, rule_id: str, group: list[Column], key: str, field_name: str, message) -> DataFrame:  # noqa: ANN001
    """A warning for each group of more than one row: keys in input order, joined; groups sort by their first row. message takes the name of the first group column.

    Groups are counted first, which combines before the shuffle; only rows of groups of several go on. They are sorted by range of (group, order), so a group of any size lies in many tasks, and its keys are
    joined in chunks of ``CHUNK`` rows, and the chunks' texts in their order. No task holds the rows of a group, but for the text that is the result.
    """
    names = [f"_g{i}" for i in range(len(group))]
    found = rows.select("_seq", F.col(key).alias("_key"), F.struct(*(g.alias(n) for g, n in zip(group, names, strict=True))).alias("_g"))
    several = found.groupBy("_g").agg(F.min("_seq").alias("_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = found.join(several, "_g").repartitionByRange("_g", "_seq").sortWithinPartitions("_g", "_seq").withColumn("_chunk", F.floor(F.monotonically_increasing_id() / CHUNK))
    joined = lambda order, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), ", ")
    chunks = placed.groupBy("_g", "_chunk").agg(F.first("_first").alias("_first"), joined("_seq", "_key").alias("_keys"))
    found = chunks.groupBy("_g").agg(F.first("_first").alias("_seq"), joined("_chunk", "_keys").alias("key")).select("key", "_seq", "_g.*")
    return found.select(F.lit(rule_id).alias("rule_id"), F.lit(WARN).alias("action"), F.lit(object_name).alias("object"), "key", F.lit(field_name).alias("field"), message(F.col(names[0])).alias("message"), "_seq")
