"""Scan rules: the catalogue as a relation, evidence as Columns, findings, and the link to an inventory."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.constants import DB_STATEMENT, GUIDANCE, OBJECT_RULE, RULES, SEVERITIES, SUBJECTS, WRITE_STATEMENT
from ledgerloom.functions import lookup, strip, truncate


@dataclass(frozen=True)
class Rule:
    id: str
    title: str
    category: str
    severity: str
    points: int
    tables: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    write_only: bool = False
    in_loop: bool = False

    def evidence(self, text: Column, depth: Column, words: Column | None = None) -> Column:
        """The first table, in the rule's order, that a database statement names, else the first pattern's match; null for none.

        words: see ``named``. The cheap tests come first: the loop, the words, then the kind of statement; a pattern is matched only where a word that all its matches hold is there.
        """
        words = named(text, (self,)) if words is None else words
        has = lambda w: F.array_contains(words, w.upper())
        tables = [F.when(has(t), F.lit(t.upper())) for t in self.tables]
        match = lambda p: F.nullif(strip(F.regexp_extract(text, f"(?i){p}", 0)), F.lit(""))
        matches = [F.when(has(w), match(p)) if (w := needed_word(p)) else match(p) for p in self.patterns]
        found = F.coalesce(*tables, *matches)
        if self.tables:
            needs = [*self.tables, *map(needed_word, self.patterns)]
            some = F.lit(True) if None in needs else F.arrays_overlap(words, F.array(*(F.lit(w.upper()) for w in needs)))
            found = F.when(some & text.rlike(WRITE_STATEMENT if self.write_only else DB_STATEMENT), found)
        return F.when(depth > 0, found) if self.in_loop else found


# In a pattern, a literal that stands between what can only match at the ends of words.
_WHOLE_WORD = re.compile(r"(?:\\b|\\s\+|\^\\s\*|')([A-Za-z0-9_]{3,})(?=\\b|\\s\+|'|(?:\\s\*)?(?:\\\(|:))")


def needed_word(pattern: str) -> str | None:
    """A word that every match of the pattern holds as a whole word, the longest; None if that cannot be told."""
    return None if re.search(r"[|?{]", pattern) else max(_WHOLE_WORD.findall(pattern), key=len, default=None)


def needed_text(pattern: str) -> str | None:
    """Signs and digits that every match of the pattern holds one after the other, the longest; None if that cannot be told."""
    runs = [] if re.search(r"[][|?{*]", pattern) else re.findall(r"(?:\\[^\w\s]|(?<![\w\\])[0-9]+(?!\w))+(?!\+)", pattern)
    return max((r.replace("\\", "") for r in runs), key=len, default=None)


def named(text: Column, rules: Iterable[Rule]) -> Column:
    """Array of the words of a statement, in upper case, that are tables of rules or that their patterns need. The statement is searched once for all rules."""
    wanted = dict.fromkeys(w.upper() for r in rules for w in (*r.tables, *map(needed_word, r.patterns)) if w)
    if not wanted:
        return F.array().cast("array<string>")
    # Words as the patterns' own word ends see them: letters of any script belong to a word. Those of one first letter are tried together.
    rest: dict[str, list[str]] = {}
    for w in wanted:
        rest.setdefault(w[0], []).append(re.escape(w[1:]))
    one = "|".join(f"{re.escape(c)}(?:{'|'.join(some)})" for c, some in rest.items())
    return F.array_distinct(F.regexp_extract_all(F.upper(text), F.lit(rf"(?U)(?<!\w)(?:{one})(?!\w)"), F.lit(0)))


def _of_words(words: Column, values: dict[str, list[Column]], kind: str) -> Column:
    """Array of the values of all words; none for a word without."""
    empty = F.array().cast(f"array<{kind}>")
    if not values:
        return empty
    pairs = F.create_map(*(x for w, some in values.items() for x in (F.lit(w), F.array(*some))))
    return F.flatten(F.transform(words, lambda w: F.coalesce(F.try_element_at(pairs, w), empty)))


def _by_tables(rules: list[Rule], words: Column, writes: Column) -> Column:
    """Array of (rule_id, place, evidence): tables among the words of a database statement, once for each rule that names them. place: that of the table in its rule."""

    def of(some: list[Rule]) -> Column:
        values: dict[str, list[Column]] = {}
        for r in some:
            for i, t in enumerate(dict.fromkeys(t.upper() for t in r.tables)):
                values.setdefault(t, []).append(F.struct(F.lit(r.id).alias("rule_id"), F.lit(i).alias("place"), F.lit(t).alias("evidence")))
        return _of_words(words, values, "struct<rule_id:string,place:int,evidence:string>")

    return F.when(writes, of(rules)).otherwise(of([r for r in rules if not r.write_only]))


def _asked(rules: list[Rule], text: Column, words: Column) -> Column:
    """Array of the numbers of the rules that may have evidence: a word of theirs is there, or what a pattern without such a word needs."""
    values: dict[str, list[Column]] = {}
    bare = []
    for i, r in enumerate(rules):
        needs = [*r.tables, *map(needed_word, r.patterns)]
        for w in dict.fromkeys(w.upper() for w in needs if w):
            values.setdefault(w, []).append(F.lit(i))
        for p in (p for p in r.patterns if not needed_word(p)):
            there = F.contains(text, F.lit(needed_text(p))) if needed_text(p) else F.lit(True)
            bare.append(F.when(there, F.array(F.lit(i))).otherwise(F.array().cast("array<int>")))
    return F.array_distinct(F.concat(_of_words(words, values, "int"), *bare))


CATALOGUE = tuple(Rule(*r) for r in RULES)
BY_ID = {r.id: r for r in CATALOGUE}
STATEMENT_RULES = tuple(r for r in CATALOGUE if r.id != OBJECT_RULE)


def catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, r.id, r.title, r.category, r.severity, r.points, GUIDANCE.get(r.id, ""), SUBJECTS.get(r.id, "")) for i, r in enumerate(CATALOGUE)],
                                 "seq int, rule_id string, title string, category string, severity string, effort_points int, guidance string, sap_reference string")


def selected(include: Iterable[str] = (), exclude: Iterable[str] = (), rules: Iterable[Rule] = CATALOGUE) -> list[Rule]:
    include, exclude = set(include), set(exclude)
    return [r for r in rules if (not include or r.id in include) and r.id not in exclude]


def rank(severity: Column) -> Column:
    return lookup(severity, {s: i for i, s in enumerate(SEVERITIES)})


def findings(statements: DataFrame, rules: Iterable[Rule] = STATEMENT_RULES, key: str = "path") -> DataFrame:
    """One row a statement and rule that it breaks: key, line, rule_id, evidence, statement. All rules are evaluated in one projection over the statement's words; nothing is joined.

    The words lead to the rules. Of rules of tables alone each word has those that name it, and of a rule's tables its first one counts; the kind of statement is told once for them. Other rules are asked for evidence where a word of theirs is there.
    """
    text, depth, words, rules = F.col("text"), F.col("loop_depth"), F.col("_words"), list(rules)
    by_table = [r for r in rules if r.tables and not r.patterns and not r.in_loop]
    others = [r for r in rules if r not in by_table]
    hit = lambda rule_id, evidence: F.struct(rule_id.alias("rule_id"), evidence.alias("evidence"))
    hits = [F.array().cast("array<struct<rule_id:string,evidence:string>>")]
    rows = statements.withColumn("_words", named(text, rules))
    if others:
        evidence = lambda i: F.coalesce(*(F.when(i == n, r.evidence(text, depth, words)) for n, r in enumerate(others)))
        rows = rows.withColumn("_asked", _asked(others, text, words))
        hits.append(F.filter(F.transform("_asked", lambda i: hit(F.element_at(F.array(*(F.lit(r.id) for r in others)), i + 1), evidence(i))), lambda x: x["evidence"].isNotNull()))
    if by_table:
        rows = rows.withColumn("_tables", F.when((F.size(words) > 0) & text.rlike(DB_STATEMENT), _by_tables(by_table, words, text.rlike(WRITE_STATEMENT))))
        earlier = lambda x: F.exists("_tables", lambda y: (y["rule_id"] == x["rule_id"]) & (y["place"] < x["place"]))
        hits.append(F.when(F.size("_tables") > 0, F.transform(F.filter("_tables", lambda x: ~earlier(x)), lambda x: hit(x["rule_id"], x["evidence"]))).otherwise(hits[0]))
    # With inline() Spark would ask for a size above 0 first, push that below and so evaluate the rules once more for each time that their parts are named.
    rows = rows.select(key, "line", "text", F.inline_outer(F.concat(*hits))).where("rule_id is not null")
    return rows.select(key, "line", "rule_id", "evidence", truncate(text).alias("statement"))


def with_metadata(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Findings with title, category, severity, points, guidance and subject of their rule; the catalogue has one row a rule."""
    return rows.join(F.broadcast(catalogue(spark).drop("seq")), "rule_id")


def object_name(path: Column) -> Column:
    """Upper-case name of a file without its suffixes."""
    name = F.element_at(F.split(path, "/"), -1)
    bare = F.regexp_replace(name, r"\.(prog|clas|incl|fugr|exit)\.abap$", "")
    return F.upper(F.when(bare != name, bare).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")))


def with_inventory(paths: DataFrame, inventory: DataFrame) -> DataFrame:
    """paths(path) with the inventory entry of the same path, else the first entry whose path the file's ends with.

    Exact paths are an equi-join. For the rest every suffix of a path that an entry could equal is looked up, again by equality: entries
    are cut to their lengths, of which there are few, so no pair of a file and an entry is formed.
    """
    clean = lambda c: F.ltrim(F.col(c), F.lit("./"))
    entries = inventory.select(clean("path").alias("_entry"), F.struct("_seq", F.struct(*(c for c in inventory.columns if c not in ("path", "_seq"))).alias("e")).alias("_row")).where("_entry <> ''")
    # Entries of one path: the last counts, in the place of the first.
    first = entries.groupBy("_entry").agg(F.min(F.col("_row._seq")).alias("_s"), F.max_by("_row", F.col("_row._seq")).alias("_row"))
    last = first.select("_entry", F.col("_row").alias("_exact"))
    rows = paths.select("path", clean("path").alias("_path"))
    exact = rows.join(last, F.col("_path") == F.col("_entry"), "left").select("path", "_path", "_exact")
    lengths = [r[0] for r in first.select(F.length("_entry").alias("n")).distinct().orderBy("n").collect()]  # as many as the longest path has characters, at most
    ends = F.array(*(F.when(F.length("_path") >= n, F.right(F.col("_path"), F.lit(n))) for n in lengths)) if lengths else F.array().cast("array<string>")
    tails = exact.where("_exact is null").select("path", F.explode(F.array_compact(ends)).alias("_entry")).join(first, "_entry").groupBy("path").agg(F.min_by("_row", "_s").alias("_tail"))
    return exact.join(tails, "path", "left").select("path", F.coalesce("_exact", "_tail").alias("_row")).select("path", F.col("_row.e.*"))


def for_name(names: DataFrame, inventory: DataFrame) -> DataFrame:
    """names(name) with the inventory entry of that object name, whatever its case; of several the last."""
    columns = [c for c in inventory.columns if c != "_seq"]
    entries = inventory.groupBy(F.upper("object_name").alias("_name")).agg(F.max_by(F.struct(*columns), F.col("_seq")).alias("_e"))
    return names.join(entries, F.upper("name") == F.col("_name"), "left").select("name", "_e.*")


def waves(inventory: DataFrame) -> DataFrame:
    """(wave): the waves that objects are planned for, in order."""
    return inventory.select("wave").distinct().orderBy("wave")


def object_findings(objects: DataFrame, tests: DataFrame) -> DataFrame:
    """Objects of a validated class without a test file of their own name. objects: path, object_name, gxp_class, validation_package; tests: name."""
    bare = objects.where(F.col("gxp_class").isin("gxp_critical", "gxp_relevant")).withColumn("name", F.lower("object_name"))
    return bare.join(tests, "name", "left_anti").select("path", F.lit(1).alias("line"), F.lit(OBJECT_RULE).alias("rule_id"), F.col("gxp_class").alias("evidence"), F.concat(F.col("object_name"), F.lit(" ("), F.col("validation_package"), F.lit(")")).alias("statement"))
