"""Row rules on a stream: an extension. Only rules of single rows fit a stream; groups, documents and reconciliation need a bounded input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.issues import RowRule, annotate
from ledgerloom.operators.rules import STATEMENT_RULES, findings


def row_issues(stream: DataFrame, object_name: str, key: Column, rules: list[RowRule]) -> DataFrame:
    """Issues of a stream's rows as they arrive."""
    return annotate(stream, object_name, key, rules).select(F.inline("_issues"))


def statement_findings(stream: DataFrame, key: str = "path") -> DataFrame:
    """Findings of a stream of statements (key, line, text, loop_depth)."""
    return findings(stream, STATEMENT_RULES, key)


def counts_by_window(stream: DataFrame, time: str, late: str, width: str, *keys: str) -> DataFrame:
    """Rows by window and keys; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))
