"""Scalar building blocks as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.constants import WHITE_SPACE


def strip(c: Column) -> Column:
    """Without white space at both ends, as str.strip() does."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def stripped(c: Column) -> Column:
    """As strip(), which is called only where a value begins or ends with what may be white space. For values at hand: c is looked at several times."""
    shown = lambda x: F.ascii(x).between(33, 126)
    return F.when(shown(c) & shown(F.right(c, F.lit(1))), c).otherwise(strip(c))


def strip_zeros(c: Column) -> Column:
    """Without leading zeros; all zeros give '0'."""
    return F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), F.lit("0"))


def lookup(c: Column, values: Mapping[str, object], default: Column | None = None) -> Column:
    """Value by key from a literal map; default, or null, for other keys."""
    pairs = F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    found = F.try_element_at(pairs, c)
    return found if default is None else F.coalesce(found, default)


def money(c: Column, scale: int, empty_as_zero: bool = False) -> Column:
    """A decimal from its string. An empty string is zero or, strictly, an error."""
    return (F.when(c == "", F.lit("0")).otherwise(c) if empty_as_zero else c).cast(f"decimal(38,{scale})")


def fixed(c: Column, scale: int) -> Column:
    """A number as text with that many decimals, ties to even."""
    return F.bround(c, scale).cast(f"decimal(38,{scale})").cast("string")


def flag(c: Column) -> Column:
    """'true' for X, 'false' for anything else."""
    return F.when(c == "X", "true").otherwise("false")


def truncate(c: Column, limit: int = 160) -> Column:
    """White space collapsed; beyond the limit cut and ended by dots."""
    flat = strip(F.regexp_replace(c, r"(?U) \s+|[\s&&[^ ]]\s*", " "))  # single spaces are left as they are
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit - 3), F.lit("..."))).otherwise(flat)


# As many values of a key, of so many rows each, are looked up as constants.
HOT_KEYS, HOT_ROWS = 64, 10_000


def left_join(rows: DataFrame, key: str, side: DataFrame, order: str = "_seq") -> DataFrame:
    """rows with the other columns of side, which has one row a key at most; null without one. key: text. order: a column that tells rows apart.

    A key that very many rows hold would bring them all into one task. The most frequent are counted, which combines before the shuffle; what side has for them becomes constants, and their rows are dealt out by their order.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS)
    hot = [r[0] for r in counts.orderBy(F.desc("n")).limit(HOT_KEYS).collect()]
    if not hot:
        return rows.join(side, key, "left")
    values = [c for c in side.columns if c != key]
    known, is_hot = side.where(F.col(key).isin(hot)).collect(), F.col(key).isin(hot)
    spread = F.when(is_hot, F.concat(F.lit("\0"), F.pmod(F.xxhash64(order), F.lit(4096)).cast("string"))).otherwise(F.col(key))
    found = rows.withColumn("_j", spread).join(side.withColumnRenamed(key, "_j"), "_j", "left")
    fixed_ = {c: F.when(is_hot, lookup(F.col(key), {r[key]: r[c] for r in known}) if known else F.lit(None)).otherwise(F.col(c)) for c in values}
    return found.withColumns(fixed_).drop("_j")


def ranges(c: Column, rows: list[tuple[str, str, str, str | None]]) -> Column:
    """Whether c is in a range list of (sign I or E, option EQ or BT, low, high). No includes means everything; excludes take away."""
    one = lambda option, low, high: c == low if option == "EQ" else c.between(low, high)
    include, exclude = ([one(o, low, high) for s, o, low, high in rows if s == sign] for sign in "IE")
    result = F.lit(not include)
    for x in include:
        result = result | x
    for x in exclude:
        result = result & ~x
    return result


def disjoint(intervals: DataFrame) -> DataFrame:
    """(low, high) of integers that cover what the given intervals cover, without overlap: each is cut to what lies beyond all that begin before it.

    In two levels: by position of the low end in as many bins as the root of their number, each with the furthest end of the bins before it.
    """
    rows = intervals.where("low <= high").select(F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"))
    n, least, most = rows.agg(F.count("*"), F.min("low"), F.max("low")).first()
    width = max(1, ((most or 0) - (least or 0)) // max(1, int(n**0.5)) + 1)
    rows = rows.withColumn("bin", F.expr(f"(low - {least or 0}L) div {width}L"))
    ends = rows.groupBy("bin").agg(F.max("high").alias("end"))
    before = ends.select("bin", F.max("end").over(Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)).alias("_far"))  # one row a bin
    inside = F.max("high").over(Window.partitionBy("bin").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    reach = F.greatest(F.col("_near"), F.col("_far"))
    rows = rows.withColumn("_near", inside).join(before, "bin").withColumn("_low", F.greatest(F.col("low"), reach + 1))
    return rows.where("_low <= high").select(F.col("_low").alias("low"), "high")


def in_intervals(rows: DataFrame, column: str, intervals: DataFrame, how: str) -> DataFrame:
    """rows whose integer column lies in an interval (how: left_semi) or in none (left_anti). intervals: (low, high).

    Values are looked up by equality. Intervals of one value are the values themselves. The others are made disjoint and cut at the borders of bins whose width is the mean share of an interval, so they give two rows each on average at most.
    """
    single = intervals.where("low = high").select(F.col("low").cast("long").alias("_v")).distinct()
    longer = disjoint(intervals.where("low < high"))
    n, least, most = longer.agg(F.count("*"), F.min("low"), F.max("high")).first()
    width = max(1, ((most or 0) - (least or 0)) // max(1, n) + 1)
    bin_of = lambda c: F.expr(f"({c} - {least or 0}L) div {width}L")
    cut = longer.select("low", "high", F.explode(F.sequence(bin_of("low"), bin_of("high"))).alias("_bin"))
    value = F.col(column).cast("long")
    hit = lambda some, how: some.withColumn("_b", bin_of(f"CAST(`{column}` AS BIGINT)")).join(cut, (F.col("_b") == F.col("_bin")) & value.between(F.col("low"), F.col("high")), how).drop("_b")
    if how == "left_anti":
        return hit(rows.join(single, value == F.col("_v"), "left_anti"), "left_anti")
    return rows.join(single, value == F.col("_v"), "left_semi").unionByName(hit(rows.join(single, value == F.col("_v"), "left_anti"), "left_semi"))


def in_range_list(rows: DataFrame, column: str, entries: DataFrame) -> DataFrame:
    """rows whose integer column a list of any length selects. entries: sign (I or E), option (EQ or BT), low, high. No includes mean everything; excludes take away; null is selected by no include and taken away by no exclude."""
    high = F.when(F.col("option") == "EQ", F.col("low")).otherwise(F.col("high"))
    part = lambda sign: entries.where(F.col("sign") == sign).select("low", high.alias("high"))
    includes = part("I")
    if includes.limit(1).count():
        rows = in_intervals(rows, column, includes, "left_semi")
    return in_intervals(rows, column, part("E"), "left_anti")
