"""Extracts, inventories and source texts as DataFrames, each row with an order of its own.

``_seq`` is a struct (file, block, order) that sorts as the file is written. It is an order, not a number: numbering rows would bring
all of them into one task.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.constants import WAVE_FILES
from ledgerloom.functions import stripped
from ledgerloom.functions.blocks import joined, two_states
from ledgerloom.sources.sinks import HEADER, PART, read_text


class ExtractError(Exception):
    """An extract is missing or cannot be read."""


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


# A field of a record: quoted, with doubled quotes inside and whatever follows up to the comma, or plain, or empty. Groups are possessive, so the matcher neither recurses nor goes back.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = rf'(?:{_QUOTED}|[^",][^,]*+|)'
_CLOSED = rf"^{_FIELD}(?:,{_FIELD})*+\z"
_CLOSES = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\z'
_EACH = rf',({_QUOTED}|"[^"]*+(?:""[^"]*+)*+\z|[^",][^,]*+|)'


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """_k (file), _block (where the split begins), order, text with its end: CR LF, LF or a CR by itself; the last line of a file gets an LF if it has no end."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.struct(F.col("_metadata.file_path").alias("file")).alias("_k"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("row"), "value")
    # Without a CR, or with one at the end only, a line is whole as it is.
    whole = (F.instr("value", "\r") == 0) | (F.instr("value", "\r") == F.length("value"))
    parts = F.when(whole, F.array(F.concat("value", F.lit("\n")))).otherwise(F.split(F.concat("value", F.lit("\n")), r"(?<=\r)(?!\n)"))
    return rows.select("_k", "_block", "row", F.posexplode(parts).alias("part", "text")).select("_k", "_block", F.struct("row", "part").alias("order"), "text")


def _closed(text: Column) -> Column:
    """Whether a line that is met outside a quoted field ends outside one. Only lines with a quote are matched."""
    return ~F.contains(text, F.lit('"')) | text.rlike(_CLOSED)


def _closes(text: Column) -> Column:
    """Whether a line that is met inside a quoted field ends outside one."""
    return F.contains(text, F.lit('"')) & text.rlike(_CLOSES)


def _records(lines: DataFrame) -> DataFrame:
    """The same columns: lines put together where a quoted field holds their ends."""
    lines = two_states(lines, ~_closed(F.col("text")), ~_closes(F.col("text")))
    ends = F.when(F.col("_state") == 0, _closed(F.col("text"))).otherwise(_closes(F.col("text")))
    return joined(lines.withColumn("ends", ends), "").select("_k", "_block", "order", "text")


def _fields(text: Column) -> Column:
    """The values of a record. One without quotes, which so is a single line, is cut at its commas."""
    plain = F.split(F.rtrim(text, F.lit("\r\n")), ",", -1)
    bare = F.regexp_replace(text, r"(?:\r\n|\n|\r)\z", "")
    inner = lambda f, i: F.regexp_extract(f, r'^"([^"]*+(?:""[^"]*+)*+)"?+([^,]*+)\z', i)
    value = lambda f: F.when(f.startswith('"'), F.concat(F.replace(inner(f, 1), F.lit('""'), F.lit('"')), inner(f, 2))).otherwise(f)
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), bare), F.lit(_EACH), F.lit(1)), value)
    return F.when(F.contains(text, F.lit('"')), quoted).otherwise(plain)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as stripped strings, missing values as '', and _seq. The first record of each file is its header, as of the first file, unless path is a folder of ``write_parts``, which has it in a file of its own; empty lines are no records.

    Files stay splittable whatever their fields hold. A line leaves a quoted field open or not, depending on how it was met; if no line that is met closed leaves one open, every line is a record and nothing is shuffled. Else
    the state before each line is found by a scan over splits and their summaries (``blocks.two_states``), and lines of a record are joined.
    """
    if not exists(spark, path):
        raise ExtractError(f"extract not found: {path}")
    if exists(spark, f"{path}/{HEADER}"):
        lines, names = _raw_lines(spark, f"{path}/{PART}*"), next(csv.reader(io.StringIO(read_text(spark, f"{path}/{HEADER}"), newline="")))
        left_open = lines.agg(F.count_if(~_closed(F.col("text"))).alias("n")).first()["n"]
        return _shaped(_records(lines) if left_open else lines, names)
    lines = _raw_lines(spark, path)
    head = lines.where("_block = 0").select("text").first()
    if head is None:
        raise ExtractError(f"extract without a header: {path}")
    same = F.col("text") == F.lit(head["text"])
    seen = lines.agg(F.count_if(~_closed(F.col("text"))).alias("open"), F.count_if(same).alias("heads"), F.count_distinct("_k").alias("files"), F.count_if(same & (F.col("_block") == 0)).alias("first")).first()
    if not seen["open"] and seen["heads"] == seen["first"] == seen["files"]:
        records, names = lines.where(~same), spark.range(1).select(_fields(F.lit(head["text"])).alias("x")).first()["x"]
    else:
        records = _records(lines)
        place = F.struct("_block", "order")
        heads = records.groupBy("_k").agg(F.min(place).alias("_head"), F.min_by("text", place).alias("_text"))
        names = heads.orderBy("_k").select(_fields(F.col("_text")).alias("x")).first()["x"]
        records = records.join(F.broadcast(heads.select("_k", "_head")), "_k").where(place > F.col("_head"))  # one row a file
    return _shaped(records, names)


def _shaped(records: DataFrame, names: list[str]) -> DataFrame:
    """Columns by name and _seq of records that are no headers."""
    records = records.where(~F.col("text").isin("\n", "\r\n", "\r")).select(_fields(F.col("text")).alias("x"), F.struct("_k.file", F.col("_block").alias("block"), "order").alias("_seq"))
    return records.select(*(F.coalesce(stripped(F.get("x", F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(names) if c not in names[i + 1 :]), "_seq")


def extract_wave(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The five extracts of a wave by object."""
    if not exists(spark, directory):
        raise ExtractError(f"wave directory not found: {directory}")
    return {name: read_csv(spark, f"{directory}/{file}") for name, file in WAVE_FILES.items()}


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The object inventory, typed; a bad number is an error. remediated_path is optional."""
    rows = read_csv(spark, path)
    if "remediated_path" not in rows.columns:
        rows = rows.withColumn("remediated_path", F.lit(""))
    return rows.withColumn("monthly_executions", F.col("monthly_executions").cast("int"))


def read_sources(spark: SparkSession, root: str, suffix: str = ".abap", test_suffix: str = ".testclasses.abap") -> DataFrame:
    """(path, text) of source files below root, tests excluded. A root that is a file is read as it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop):
        raise ExtractError(f"source not found: {root}")
    reader = spark.read.format("text").option("wholetext", True)
    if system.getFileStatus(hadoop).isFile():
        return reader.load(root).select(F.lit(root).alias("path"), F.col("value").alias("text"))
    found = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    # Paths as the root was given, not as the file system spells them.
    full, base = F.col("_metadata.file_path"), system.makeQualified(hadoop).toUri().getPath().rstrip("/")
    path = F.concat(F.lit(root.rstrip("/")), F.substring(full, F.instr(full, base) + len(base), F.length(full)))
    return found.where(~full.endswith(test_suffix)).select(path.alias("path"), F.col("value").alias("text"))


def read_test_names(spark: SparkSession, root: str, test_suffix: str = ".testclasses.abap") -> DataFrame:
    """(name): lower-case names of objects that have a test file below root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{test_suffix}").load(root)
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return found.select(F.lower(F.substring(name, F.lit(1), F.length(name) - len(test_suffix))).alias("name")).distinct()


def cut_lines(text: Column) -> Column:
    """Array of the lines of a text, with an empty one after a line end at the end. Line ends other than LF, where there are any, become LF first: a single sign is split at without a pattern."""
    other = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    plain = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), other, "\n" * len(other))
    return F.split(F.when(text.rlike(f"[{other}]"), plain).otherwise(text), "\n")


def lines_of(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line, text): lines of each text, from 1, split as str.splitlines() does."""
    texts, parts = texts.select(key, cut_lines(F.col(text)).alias("_lines")), F.col("_lines")  # split once
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    # With posexplode() Spark would ask for a size above 0 first, push that below and so split twice.
    return texts.select(key, F.posexplode_outer(parts).alias("_at", "_line")).where("_at is not null").select(key, (F.col("_at") + 1).cast("int").alias("line"), F.col("_line").alias("text"))


__all__ = ["ExtractError", "extract_wave", "lines_of", "read_csv", "read_inventory", "read_sources", "read_test_names"]
