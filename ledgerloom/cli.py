"""Command line: migrate a wave, scan sources, list rules. Exit codes: 0 fine, 1 a gate failed, 2 an input is missing."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerloom.constants import SEVERITIES
from ledgerloom.operators import backlog, rules
from ledgerloom.plans import migration, render, scan
from ledgerloom.sources import ExtractError, exists, read_inventory
from ledgerloom.sources.sinks import Section, texts_of, write_sections


# Names of commands and options, and where inputs and outputs lie by default.
SOURCES, INVENTORY, TEST_ROOTS = "abap/src", "estate/inventory.csv", ["abap"]
FORMATS = ("summary", "markdown", "json")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom")
    sub = top.add_subparsers(dest="command", required=True)
    m = sub.add_parser("run", aliases=["migrate"], help="migrate a wave")
    m.add_argument("--wave", default="wave0")
    m.add_argument("--source", "--data", help="directory of the extracts (default: data/<wave>)")
    m.add_argument("--out", help="directory of the load files (default: out/<wave>)")
    m.add_argument("--format", choices=FORMATS, default="summary")
    m.add_argument("--dry-run", action="store_true", help="write nothing")
    m.add_argument("--fail-on-reject", action="store_true", help="fail if any record is held back")
    m.add_argument("--parts", type=int, help="write each load as so many files, in order, for data that outgrows one")
    m.set_defaults(command="run")
    s = sub.add_parser("scan", help="scan sources")
    s.add_argument("paths", nargs="*", default=[SOURCES])
    s.add_argument("--inventory", default=INVENTORY)
    s.add_argument("--test-root", "--tests", action="append", default=[])
    s.add_argument("--format", choices=FORMATS, default="summary")
    s.add_argument("--out", help="write the report there")
    s.add_argument("--rule", "--include", action="append", default=[], help="run only these rules")
    s.add_argument("--exclude-rule", "--exclude", action="append", default=[], help="leave these rules out")
    s.add_argument("--wave", help="only objects of this wave")
    s.add_argument("--fail-on", choices=SEVERITIES, help="fail on findings as severe or worse")
    sub.add_parser("rules", help="list the rules")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "rules":
        row = "{:<12} {:<9} {:<18} {}".format
        print("\n".join([row("RULE", "SEVERITY", "CATEGORY", "TITLE"), *(row(r.id, r.severity, r.category, r.title) for r in rules.CATALOGUE)]))
        return 0
    spark = spark or SparkSession.builder.appName("ledgerloom").getOrCreate()
    try:
        return _migrate(args, spark) if args.command == "run" else _scan(args, spark)
    except ExtractError as e:
        print(e, file=sys.stderr)
        return 2


def _migrate(args: argparse.Namespace, spark: SparkSession) -> int:
    out = None if args.dry_run else args.out or f"out/{args.wave}"
    wave = migration.migrate(spark, args.wave, args.source or f"data/{args.wave}", out, args.parts)
    counts, checks = wave.counts(), [r.asDict() for r in wave.checks.orderBy("seq").collect()]  # one row a check
    if args.format == "summary":
        merged = wave.partners.merged_count().first()["merged"]
        rejects = [c.issues.where("action = 'reject'") for c in wave.cleansed.values()]
        _say(render.migration_summary(wave.name, counts, checks, wave.loads["business_partners"].count(), merged, rejects, out), end="")
    else:
        print({"json": render.reconciliation_json, "markdown": render.reconciliation_markdown}[args.format](wave.name, counts, checks))
    wave.release()
    rejected = sum(c["rejected"] for c in counts)
    if not all(c["passed"] for c in checks):
        return 1
    if args.fail_on_reject and rejected:
        print(f"{rejected} records held back from the load", file=sys.stderr)
        return 1
    return 0


def _say(sections: list[Section], end: str = "\n") -> None:
    """Print a report as it comes."""
    for text in texts_of(sections):
        print(text, end="")
    print(end=end)


def _scan(args: argparse.Namespace, spark: SparkSession) -> int:
    inventory = read_inventory(spark, args.inventory) if exists(spark, args.inventory) else None
    if inventory is None and args.inventory != INVENTORY:
        raise ExtractError(f"inventory not found: {args.inventory}")
    tests = args.test_root or [r for r in TEST_ROOTS if exists(spark, r)] or None
    found = scan.scan_paths(spark, args.paths, inventory, tests, include=args.rule, exclude=args.exclude_rule)
    found = (found.wave(args.wave) if args.wave else found).held()
    report = render.Backlog(found)
    sections = {"summary": report.summary, "json": report.json, "markdown": report.markdown}[args.format]()
    if args.out:
        write_sections(spark, args.out, sections)
        print(f"report written to {args.out}")
    else:
        _say(sections)
    gate = bool(args.fail_on) and backlog.reaches(found.outstanding_findings(), args.fail_on).first()["found"]
    found.release()
    if gate:
        print(f"findings at or above severity '{args.fail_on}' present", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
