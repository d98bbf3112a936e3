"""Source text to logical statements with their loop depth: in the row of a text of few lines, else by windows over blocks of a file's lines and over the blocks' summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.constants import LOOP_CLOSE, LOOP_OPEN, SELECT_HEAD, SET_BASED
from ledgerloom.functions import strip, stripped
from ledgerloom.functions.blocks import joined
from ledgerloom.sources import cut_lines, lines_of

# Lines of a file that one task puts together.
BLOCK_LINES = 4096
# Steps of the loop depth that are taken together, so that lists grow by parts.
STEPS = 64


def strip_comment(line: Column) -> Column:
    """The code of a line: empty if it starts with *, else cut at the last double quote that is not inside a literal, then without white space at the end."""
    # Literals are masked in pieces, so no line is too long for the matcher; an odd quote is a piece of its own.
    pieces = F.regexp_extract_all(line, F.lit("'[^']*'|[^']+|'"), F.lit(0))
    masked = F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("'") & (F.length(p) > 1), F.repeat(F.lit("_"), F.length(p))).otherwise(p)), "")
    tail = F.instr(F.reverse(masked), '"')
    code = F.when(F.contains(line, F.lit('"')), F.when(tail > 0, F.left(line, F.length(line) - tail)).otherwise(line)).otherwise(line)
    return F.when(strip(line).startswith("*"), F.lit("")).otherwise(F.regexp_replace(code, r"(?U)\s+$", ""))


def effective_lines(lines: DataFrame, key: str = "path") -> DataFrame:
    """(key, loc): lines that are neither blank nor comments from their first character."""
    text = strip(F.col("text"))
    return lines.groupBy(key).agg(F.count_if((text != "") & ~text.startswith("*")).cast("int").alias("loc"))


def effective_count(text: Column) -> Column:
    """As effective_lines, of a whole text."""
    return F.size(F.filter(cut_lines(text), lambda x: (strip(x) != "") & ~strip(x).startswith("*")))


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("_k", F.struct(F.col(key).alias(key)))


def statements(lines: DataFrame, key: str = "path", block_lines: int = BLOCK_LINES) -> DataFrame:
    """(key, stmt_no, line, text, _block): code lines joined until one ends with a full stop. What is left at the end is a statement too. _block: of ``block_lines`` lines, where a statement begins."""
    code = _keyed(lines, key).select("_k", F.floor((F.col("line") - 1) / block_lines).cast("int").alias("_block"), F.col("line").alias("order"), strip(strip_comment(F.col("text"))).alias("text")).where("text <> ''")
    found = joined(code.withColumn("ends", F.col("text").endswith(".")), " ")
    return found.select(F.col(f"_k.{key}").alias(key), F.col("no").cast("int").alias("stmt_no"), F.col("order").alias("line"), "text", "_block")


def opens_loop(text: Column) -> Column:
    return text.rlike(LOOP_OPEN) | (text.rlike(SELECT_HEAD) & ~text.rlike(SET_BASED))


def closes_loop(text: Column) -> Column:
    return text.rlike(LOOP_CLOSE)


def with_depth(rows: DataFrame, key: str = "path", order: str = "stmt_no", opens: Column | None = None, closes: Column | None = None) -> DataFrame:
    """Adds loop_depth. A closing statement lowers the depth for itself, never below zero; an opening one raises it for those after it.

    The clamped running sum is the sum less its own minimum so far. Both are taken inside blocks of a file (those of ``statements``, else of ``BLOCK_LINES`` numbers of the order) and moved by
    what the blocks before have left, of which there is one row a block: the sum of their steps and its lowest point.
    """
    up, down = (opens_loop(F.col("text")) if opens is None else opens), (closes_loop(F.col("text")) if closes is None else closes)
    if "_block" not in rows.columns:
        rows = rows.withColumn("_block", F.floor(F.col(order) / BLOCK_LINES).cast("int"))
    so_far = Window.partitionBy("_k", "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _keyed(rows, key).withColumn("_step", F.when(down, -1).when(up, 1).otherwise(0)).withColumn("_sum", F.sum("_step").over(so_far)).withColumn("_low", F.min("_sum").over(so_far))
    blocks = rows.groupBy("_k", "_block").agg(F.sum("_step").alias("_total"), F.min("_sum").alias("_least"))
    earlier = Window.partitionBy("_k").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    blocks = blocks.select("_k", "_block", "_base", F.least(F.lit(0), F.min(F.col("_base") + F.col("_least")).over(earlier)).alias("_floor"))
    depth = F.col("_base") + F.col("_sum") - F.least(F.col("_floor"), F.col("_base") + F.col("_low")) - (F.col("_step") == 1).cast("int")
    return rows.join(blocks, ["_k", "_block"]).withColumn("loop_depth", depth.cast("int")).drop("_k", "_block", "_step", "_sum", "_low", "_base", "_floor")


def _depths(steps: str) -> Column:
    """The loop depth at each of an array of steps (1, -1 or 0)."""
    empty = lambda kind: F.array().cast(kind)
    state = lambda depth, out: F.struct(depth.alias("d"), out.alias("out"))
    after = lambda a, s: state(F.greatest(F.lit(0), a["d"] + s), F.concat(a["out"], F.array(F.when(s < 0, F.greatest(F.lit(0), a["d"] + s)).otherwise(a["d"]))))
    part = lambda a, i: F.aggregate(F.slice(F.col(steps), i * STEPS + 1, F.lit(STEPS)), state(a["d"], empty("array<int>")), after)
    whole = lambda a, i: F.element_at(F.transform(F.array(part(a, i)), lambda p: state(p["d"], F.concat(a["out"], F.array(p["out"])))), 1)
    places = F.sequence(F.lit(0), F.floor(F.size(steps) / STEPS).cast("int"))
    return F.aggregate(places, state(F.lit(0), empty("array<array<int>>")), whole, lambda a: F.flatten(a["out"]))


def of_texts(texts: DataFrame, key: str = "path", text: str = "text", opens: Callable[[Column], Column] = opens_loop, closes: Callable[[Column], Column] = closes_loop) -> DataFrame:
    """(key, stmt_no, line, text, loop_depth) of whole texts, as ``statements`` and ``with_depth`` give them.

    A text of at most ``BLOCK_LINES`` lines is cut where it is, and nothing is shuffled: its code lines, each with its number, are put together and split after full stops. Longer ones, if there are any, go through blocks.
    """
    # Line ends by themselves, so CR LF counts twice: never fewer than there are.
    ends = F.length(text) - F.length(F.translate(text, "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029", ""))
    long = (F.length(text) >= BLOCK_LINES) & (ends >= BLOCK_LINES)
    rows = texts.select(key, F.col(text).alias("text"))
    few = rows.where(~F.coalesce(long, F.lit(False))).select(key, F.transform(cut_lines(F.col("text")), lambda x, i: F.struct((i + 1).alias("n"), stripped(x).alias("code"))).alias("_lines"))
    # Only a line with a double quote can end in a comment.
    bare = F.transform(F.filter("_lines", lambda x: (x["code"] != "") & ~x["code"].startswith("*")), lambda x: F.struct(x["n"].alias("n"), F.when(F.contains(x["code"], F.lit('"')), strip(strip_comment(x["code"]))).otherwise(x["code"]).alias("code")))
    code = F.transform(F.filter(bare, lambda x: x["code"] != ""), lambda x: F.concat(x["n"].cast("string"), F.lit("\r"), x["code"]))  # no line holds a line end
    whole = F.filter(F.split(F.replace(F.array_join(code, "\n"), F.lit(".\n"), F.lit(".\x0b")), "\x0b"), lambda x: x != "")
    one = lambda x: F.struct(F.substring_index(x, "\r", 1).cast("int").alias("line"), F.when(F.contains(x, F.lit("\n")), F.substr(F.regexp_replace(x, r"(?:^|\n)[0-9]+\r", " "), F.lit(2))).otherwise(F.substring_index(x, "\r", -1)).alias("text"))
    few = few.select(key, F.transform(whole, one).alias("_found"))
    few = few.select(key, "_found", F.transform("_found", lambda x: F.when(closes(x["text"]), -1).when(opens(x["text"]), 1).otherwise(0)).alias("_steps"))
    few = few.select(key, "_found", _depths("_steps").alias("_depth")).select(key, F.posexplode_outer(F.arrays_zip("_found", "_depth")).alias("stmt_no", "x")).where("stmt_no is not null")  # see rules.findings
    few = few.select(key, "stmt_no", "x._found.line", "x._found.text", F.col("x._depth").alias("loop_depth"))
    if not rows.agg(F.bool_or(long)).first()[0]:
        return few
    many = with_depth(statements(lines_of(rows.where(long), key), key, BLOCK_LINES), key, "stmt_no", opens(F.col("text")), closes(F.col("text")))
    return few.unionByName(many.select(few.columns))
