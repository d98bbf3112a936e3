"""Scans over ordered lines in two levels, so that one file is spread over many tasks.

Lines are dealt by (file, block). What a block does to the scan is one row; a window over a file's blocks gives what each of them begins with, and the blocks are finished apart.
Files are told apart by a struct, so that a null is a file like any other where rows are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def joined(lines: DataFrame, separator: str) -> DataFrame:
    """(_k, no, order, text, _block): lines joined until one ends what is being read; what is left at the end of a file counts too. no: from 0 in each file; order and _block: of the first line.

    lines: _k (file), _block, order (rising with the block), text, ends. Lines are joined inside their block. Where the first piece of a block goes on from an earlier one it is sent there; all others stay where they are.
    """
    before = Window.partitionBy("_k", "_block").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("_at", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    pieces = rows.groupBy("_k", "_block", "_at").agg(F.min("order").alias("order"), F.array_sort(F.collect_list(F.struct("order", "text", "ends"))).alias("all"))
    pieces = pieces.select("_k", "_block", "_at", "order", F.array_join(F.transform("all", lambda x: x["text"]), separator).alias("text"), F.element_at("all", -1)["ends"].alias("_ends"))

    blocks = pieces.groupBy("_k", "_block").agg(F.count_if("_ends").alias("_stops"), F.count("*").alias("_n"), F.bool_or(~F.col("_ends")).alias("_open"))
    in_file = Window.partitionBy("_k").orderBy("_block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_goes_on", F.coalesce(F.lag("_open").over(in_file), F.lit(False)))
    # An open end begins in its own block, unless all of the block is the middle of one piece.
    begins = F.when(F.col("_open") & ~(F.col("_goes_on") & (F.col("_n") == 1)), F.col("_block"))
    blocks = blocks.select("_k", "_block", F.coalesce(F.sum("_stops").over(earlier), F.lit(0)).alias("_ahead"), "_goes_on", F.when(F.col("_goes_on"), F.max(begins).over(earlier)).alias("_begins"))

    placed = pieces.join(blocks, ["_k", "_block"])
    carried = F.col("_goes_on") & (F.col("_at") == 0)
    tails = placed.where(carried).select("_k", F.col("_begins").alias("_block"), F.struct(F.col("_block").alias("b"), "text").alias("x"))
    tails = tails.groupBy("_k", "_block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]), separator).alias("_tail"))
    found = placed.where(~carried).join(tails, ["_k", "_block"], "left")
    text = F.when(F.col("_ends") | F.col("_tail").isNull(), F.col("text")).otherwise(F.concat("text", F.lit(separator), "_tail"))
    return found.select("_k", (F.col("_ahead") + F.col("_at")).alias("no"), "order", text.alias("text"), "_block")


def _before(rows: DataFrame, partition: list[str], order: str, to0: Column, to1: Column) -> DataFrame:
    """rows with _from0 and _from1: the state (0 or 1) before each row, if the first row is met in 0 or in 1. to0, to1: what a row makes of 0 and of 1.

    A row keeps, swaps or sets the state. So it is what was set last, swapped as often as since then.
    """
    so_far = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_swap": ((to0 == 1) & (to1 == 0)).cast("int"), "_set": F.when(to0 == to1, to0)})
    rows = rows.withColumn("_swaps", F.coalesce(F.sum("_swap").over(so_far), F.lit(0)))
    last = F.last(F.when(F.col("_set").isNotNull(), F.struct(F.col("_set").alias("state"), F.col("_swaps").alias("swaps"))), True).over(so_far)
    rows = rows.withColumn("_last", last)
    state = lambda start: ((F.coalesce(F.col("_last.state"), F.lit(start)) + F.col("_swaps") - F.coalesce(F.col("_last.swaps"), F.lit(0))) % 2).cast("int")
    return rows.withColumns({"_from0": state(0), "_from1": state(1)}).drop("_swap", "_set", "_swaps", "_last")


def two_states(lines: DataFrame, to0: Column, to1: Column) -> DataFrame:
    """lines with _state: 0 or 1, the state before each, where a file begins in 0. lines: _k, _block, order. to0, to1: what a line makes of 0 and of 1."""
    rows = _before(lines.withColumns({"_to0": to0.cast("int"), "_to1": to1.cast("int")}), ["_k", "_block"], "order", F.col("_to0"), F.col("_to1"))
    after = lambda before: F.when(F.col(before) == 0, F.col("_to0")).otherwise(F.col("_to1"))
    ends = rows.groupBy("_k", "_block").agg(F.max_by(F.struct(after("_from0").alias("to0"), after("_from1").alias("to1")), "order").alias("x")).select("_k", "_block", "x.*")
    begins = _before(ends, ["_k"], "_block", F.col("to0"), F.col("to1")).select("_k", "_block", F.col("_from0").alias("_begin"))
    return rows.join(begins, ["_k", "_block"]).withColumn("_state", F.when(F.col("_begin") == 0, F.col("_from0")).otherwise(F.col("_from1"))).drop("_to0", "_to1", "_from0", "_from1", "_begin")
