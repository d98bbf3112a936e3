"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score. Native expressions only.

Kinds: email, ip (parts at most 255), card (12 to 19 digits passing Luhn), phone (+ and 9 to 15 digits). Beyond that
base, which always stays, the method adds iban (country code, its registered length, mod-97 of 1; 15 to 34 for codes without one), ssn (three, two and four digits in ranges that are
issued) and secret (16 characters or more of keys and tokens, letters and digits mixed). These are kept where their score reaches ``LEAST_SCORE``: an iban's checksum is enough by itself, an
ssn or a secret needs a word nearby that names it, or, for a secret, a prefix that issuers use; words that speak against it take it away again. Matches are leftmost and do not overlap within a kind; one
that fails its test is dropped and not retried. Positions count code points, the end is exclusive.

Patterns are written so that the matcher neither recurses nor retries inside a run: groups are possessive, and a
proposal starts where its run of characters starts or where the last one ended. An iban ends at its country's length, so
words, numbers and other ibans may follow; only codes without a registered length take all that could belong to them. Where a kind occurs, the text is split by its pattern once more: lengths of
the parts between give the positions, as no built-in returns them. Their running sums take n log n steps for n matches, and what is near a span is cut from chunks of the text, so the time
grows with a text's length, and hardly faster, however many spans it holds.

Null or empty text: no spans. Repeated rows each get a row, null ids are kept, extra columns are ignored, an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lengths of account numbers by country, as registered.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_COUNTRIES = "|".join(c for names in LENGTHS.values() for c in names.split())
_REGISTERED = "|".join(rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, names in LENGTHS.items())
_OTHER = rf"(?!{_COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20(?:{_COUNTRIES})[0-9]{{2}})\x20?[A-Z0-9]){{11,30}}+"
# What proposes a span of each kind, in the order of kinds.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?:(?<![A-Za-z0-9])|\G)(?:{_REGISTERED}|{_OTHER})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_/+.-])[A-Za-z0-9_/+-]{16,}+(?![.@])",
}
# Prefixes of keys and tokens that name themselves.
_ISSUED = r"^(?:AKIA[0-9A-Z]{16}|gh[opsu]_|github_pat_|glpat-|sk_live_|xox[abps]-|AIza|eyJ)"
# The prior score of a confirmed span, and words that raise it when they stand within REACH characters.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "secret": 0.3}
# What a word nearby adds to the score, and what one against it takes.
GAIN = {"email": 0.1, "ip": 0.1, "card": 0.1, "phone": 0.1, "iban": 0.1, "ssn": 0.4, "secret": 0.5}
LOSS = 0.3
LEAST_SCORE = 0.5
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mailto|contact|write|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login|adresse)\b",
    "card": r"(?i)\b(?:card|credit|debit|visa|mastercard|amex|carte|karte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|appel)\b",
    "iban": r"(?i)\b(?:iban|bank|account|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social|security|tax|taxpayer|tin)\b",
    "secret": r"(?i)(?:\b|_)(?:secret|token|passwd|password|pwd|api_?key|access_?key|private_?key|bearer|authorization|credentials?)\b",
}
AGAINST = r"(?i)\b(?:example|version|isbn|sku|order|test)\b"
REACH = 30
BASE = ("email", "ip", "card", "phone")
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"


def _digits(c: Column) -> Column:
    return F.translate(c, " ().+-", "")


def mod97(c: Column) -> Column:
    """Remainder of an account number whose first four characters go to the end, letters counting 10 to 35."""
    s = F.concat(F.substr(c, F.lit(5)), F.substr(c, F.lit(1), F.lit(4)))
    value = lambda x: F.when(x.between("0", "9"), F.ascii(x) - 48).otherwise(F.ascii(x) - 55)
    return F.aggregate(F.split(s, ""), F.lit(0), lambda a, x: F.when(x == "", a).otherwise((F.when(x.between("0", "9"), a * 10).otherwise(a * 100) + value(x)) % 97))


def confirmed(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(_IP)
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(12, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "ssn":
        return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":
        return m.rlike("[0-9].*[0-9].*[0-9]") & m.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]")
    d = F.translate(m, " ", "")
    return F.length(d).between(15, 34) & (mod97(d) == 1)


def running_sums(values: Column) -> Column:
    """Sums of the first 1, 2, ... values of an array of ints: values are added at distances of 1, 2, 4, ... until one reaches over all of them, so n values take n log n steps."""
    shifts = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(shifts, values, lambda sums, d: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - d), F.lit(0))))


def proposals(kind: str, text: str = "text") -> Column:
    """Array of structs (m, start) of all matches, confirmed or not; null where there is none."""
    t, pattern = F.col(text), F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(t, pattern, F.lit(0))
    # What no span of a kind can do without, looked for before its pattern: every kind but email needs digits.
    digits = t.rlike("[0-9]")
    gate = {"email": t.contains("@"), "phone": t.contains("+") & digits, "ip": t.contains(".") & digits, "ssn": t.contains("-") & digits}.get(kind, digits)
    between = F.split(t, PATTERNS[kind], -1)

    def place(m: Column, gaps: Column) -> Column:
        ends = running_sums(F.zip_with(m, F.slice(gaps, F.lit(1), F.size(m)), lambda x, gap: F.length(gap) + F.length(x)))
        return F.zip_with(m, ends, lambda x, end: F.struct(x.alias("m"), (end - F.length(x)).alias("start")))

    return F.when(gate, F.when(F.regexp_like(t, pattern), place(found, between)))


# Code points of a chunk. What is near a span is cut from two chunks, as a place in a string is only found by counting from its beginning.
CHUNK = 512


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and an array of structs (kind, start, end, score) of confirmed spans, by start and then by kind."""
    order = {k: i for i, k in enumerate(PATTERNS)}
    rows = docs.select("doc_id", "text", *(proposals(k).alias(k) for k in PATTERNS))
    chunks = F.when(F.coalesce(*(F.when(F.col(k).isNotNull(), True) for k in PATTERNS)), F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    rows = rows.select("doc_id", chunks.alias("chunks"), *PATTERNS)

    def cut(at: Column, n: Column) -> Column:
        """n code points from a place on, n being at most CHUNK."""
        i = F.floor(at / CHUNK).cast("int")
        two = F.concat(F.coalesce(F.get("chunks", i), F.lit("")), F.coalesce(F.get("chunks", i + 1), F.lit("")))
        return F.substring(two, at - i * CHUNK + 1, n)

    def keep(kind: str) -> Column:
        def one(s: Column) -> Column:
            end = s["start"] + F.length(s["m"])
            left = F.greatest(s["start"] - REACH, F.lit(0))
            near = F.concat(cut(left, s["start"] - left), F.lit(" "), cut(end, F.lit(REACH)))
            score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), GAIN[kind]).otherwise(0.0) - F.when(near.rlike(AGAINST), LOSS).otherwise(0.0)
            if kind == "secret":
                score += F.when(s["m"].rlike(_ISSUED), 0.5).otherwise(0.0)
            return F.struct(s["start"].alias("start"), F.lit(order[kind]).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), F.round(score, 2).alias("score"))

        empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
        found = F.transform(F.filter(F.col(kind), lambda s: confirmed(kind, s["m"])), one)
        return F.coalesce(found if kind in BASE else F.filter(found, lambda s: s["score"] >= LEAST_SCORE), empty)

    return rows.select("doc_id", F.array_sort(F.concat(*(keep(k) for k in PATTERNS))).alias("spans"))


def base_digest(found: DataFrame) -> DataFrame:
    """Counts, joined spans and their hash of the base kinds only."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    text = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(text, 256).alias("base_sha256"), text.alias("base_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and the joined spans of each document."""
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in PATTERNS), F.size("spans").cast("long").alias("n_spans"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))
