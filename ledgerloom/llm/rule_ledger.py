"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores one failure bit a rule and the measurements behind
them. Policies are versioned sets of bits applied to the stored ledger, and ablations (what a rule alone removes, what
a policy without it keeps) come from aggregating bits; neither reads a text again.

Null or empty text: no words, so the word-count rule fails. A text without words has zero ratios. Repeated rows each
get their own row, null ids are kept, and extra columns of the input are ignored. Whole texts are measured, whatever
their length; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, texts

# Rule names by bit.
RULES = (
    "few_words",
    "repeated_words",
    "word_length",
    "symbols",
    "duplicate_lines",
    "capitals",
    "bars",
    "letters",
)
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
# Versioned policies, the rules that reject.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "word_length", "symbols", "duplicate_lines"),
    3: ("few_words", "repeated_words", "word_length", "symbols", "duplicate_lines", "capitals", "bars", "letters"),
}
LATEST = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
    "n_capitals long, n_letters long, n_bars long, failed_bits long"
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE, _SYMBOL = _table(b" \t\n\x0b\x0c\r"), _table(b"#*$%&|<>")
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)]))
_START = np.array([b & 0xC0 != 0x80 for b in range(256)])


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that is found twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    twice = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    data = np.frombuffer(text, np.uint8)
    lines, seen, dup, n_lines = text.split(b"\n"), set(), 0, 0
    for line in lines:
        if line.strip():
            n_lines += 1
            dup += line in seen
            seen.add(line)
    n = len(words)
    counts = np.bincount(data, minlength=256)
    chars = int(counts[_START & ~_SPACE].sum())
    symbols, upper, letters = (int(counts[t].sum()) for t in (_SYMBOL, _UPPER, _LETTER))
    repeats, bars = repeated_words(words), words.count(b"|")
    failed = 0
    for name, fails in (
        ("few_words", n < 50),
        ("repeated_words", 100 * repeats > 50 * n),
        ("word_length", n > 0 and not 2 * n <= chars <= 15 * n),
        ("symbols", symbols * 10 > n),
        ("duplicate_lines", 2 * dup > n_lines),
        ("capitals", 10 * upper > 4 * letters),
        ("bars", 10 * bars > n),
        ("letters", 2 * letters < chars),
    ):
        failed |= BIT[name] * bool(fails)
    return n, chars, symbols, dup, repeats, n_lines, upper, letters, bars, failed


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): measurements and failure bits."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([measure(t or b"") for t in texts(batch.column(1))], np.int64).reshape(-1, 10)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(found[:, i]) for i in range(10))], names)

    return arrow_map(docs.select("doc_id", "text"), f, SCHEMA)


def mask(rules: Iterable[str]) -> int:
    return sum(BIT[r] for r in set(rules))


def apply_policy(rows: DataFrame, version: int = LATEST) -> DataFrame:
    """Adds base_failed and kept under the policy of that version."""
    bits = F.col("failed_bits")
    return rows.withColumns({
        "base_failed": bits.bitwiseAND(F.lit(BASE)) != 0,
        "kept": bits.bitwiseAND(F.lit(BASE | mask(POLICIES[version]))) == 0,
    })


def verdicts(rows: DataFrame, version: int = LATEST) -> DataFrame:
    """Adds kept_v<n> of every policy, and only_rule: the rule that alone rejects a document under the policy of ``version``, which its ablation would keep; else null."""
    bits, m = F.col("failed_bits"), mask(POLICIES[version])
    alone = F.coalesce(*(F.when(bits.bitwiseAND(F.lit(m)) == BIT[r], r) for r in POLICIES[version]))
    return rows.withColumns({f"kept_v{v}": bits.bitwiseAND(F.lit(BASE | mask(rules))) == 0 for v, rules in POLICIES.items()} | {"only_rule": alone})


def ablations(rows: DataFrame, version: int = LATEST) -> DataFrame:
    """(rule, failed, only, kept_without): documents that fail a rule, that fail it alone under the policy, and that the policy keeps without it."""
    m = mask(POLICIES[version])
    counts = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[version])))
    hit = F.col("bits").bitwiseAND(F.col("r.bit"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return counts.select("bits", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit != 0)("failed"), total(F.col("bits") == F.col("r.bit"))("only"), total((F.col("bits") == F.col("r.bit")) | (F.col("bits") == 0))("kept_without"))
