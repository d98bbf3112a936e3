import hashlib
import re
from collections import Counter

from ledgerloom.llm import pii, rule_ledger

EDGES = [None, "", "   \n\t", "one", "a b c a b c", "word " * 5000, "l\nl\nl\n\n x", "ünï # * $ | <b>&\nz", "a|b | c | d", "\x85a\xa0b c"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_measurements_match_brute_force(docs_of):
    rows = {r["doc_id"]: r for r in rule_ledger.ledger(docs_of(EDGES)).collect()}
    for i, t in enumerate(EDGES):
        assert tuple(rows[i])[1:6] == brute(t), t


def test_policies_and_ablations(docs_of):
    clean = " ".join(f"w{i}word" for i in range(80)) + "."
    junk = " ".join(f"w{i}&&&" for i in range(80))
    rows = rule_ledger.apply_policy(rule_ledger.ledger(docs_of([clean, junk, "short", clean.upper()])))
    assert {r["doc_id"]: r["kept"] for r in rows.collect()} == {0: True, 1: False, 2: False, 3: False}
    assert {r["doc_id"]: r["kept"] for r in rule_ledger.apply_policy(rows.drop("base_failed", "kept"), 1).collect()} == {0: True, 1: True, 2: False, 3: True}
    parts = {r["rule"]: r for r in rule_ledger.ablations(rows).collect()}
    assert parts["few_words"]["only"] == 1 and parts["few_words"]["kept_without"] == 2 and parts["bars"]["failed"] == 0


def test_empty_table_and_null_id(docs_of):
    assert rule_ledger.ledger(docs_of(["x"]).where("false")).count() == 0
    assert rule_ledger.ledger(docs_of(["x", "x"], [None, 1])).count() == 2


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute_spans(text):
    out = [(m.start(), rank, kind, m.end()) for rank, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "", re.A) if good(kind, m[0])]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


TEXTS = [
    None, "", "mail a.b+c@ex-1.co.uk, x@y.z_d@e.f @@ a@b", "ip 1.2.3.4.5.6.7.8.9 256.1.1.1 0000255.0.0.1 1.1.1.1000", "é😀 4111 1111-1111 1111 and 4111111111111112 +1 (456) 555-2186.",
    "+49.30-1234567)) +1 2 +123456789012345678", "4111111111111111 a@b.c " * 50, "1" * 20000, "a" * 20000 + "@b.c", "1 " * 9000 + "x", "+1" + "-" * 9000, "a@b.c" * 400, "..@..a.b" * 30, "12.3" * 300,
    "+" * 50 + "1234567890", "x@y." + "z." * 3000 + "q",
]


def test_base_spans_match_brute_force(docs_of):
    rows = {r["doc_id"]: r for r in pii.digest(pii.spans(docs_of(TEXTS))).collect()}
    for i, t in enumerate(TEXTS):
        want = brute_spans(t)
        assert ",".join(x for x in rows[i]["spans"].split(",") if x.split(":")[0] in BASE) == want, t and t[:60]
        assert rows[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert rows[i]["n_card"] == want.count("card:") and rows[i]["n_email"] == want.count("email:")


def test_iban_checksum_and_context(docs_of):
    rows = pii.spans(docs_of(["iban DE89 3704 0044 0532 0130 00 ok", "DE88370400440532013000", "GB82WEST12345698765432"])).collect()
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["score"]) for s in r["spans"] if s["kind"] == "iban"] for r in rows}
    assert found == {0: [("iban", 5, 32, 1.0)], 1: [], 2: [("iban", 0, 22, 0.9)]}


def brute_method_spans(text):
    """ssn and secret spans by plain loops over the text."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9_/+-]+", text, re.A):
        s, before, after = m[0], text[max(0, m.start() - 30) : m.start()], text[m.end() : m.end() + 30]
        near = before + " " + after
        against = bool(re.search(r"(?i)\b(?:example|version|isbn|sku|order|test)\b", near))
        if len(s) >= 16 and text[m.end() : m.end() + 1] not in (".", "@") and text[max(0, m.start() - 1) : m.start()] != "." and sum(c.isdigit() for c in s) >= 3 and sum(c.isalpha() for c in s) >= 3:
            named = bool(re.search(r"(?i)(?:\b|_)(?:secret|token|passwd|password|pwd|api_?key|access_?key|private_?key|bearer|authorization|credentials?)\b", near))
            if 0.3 + 0.5 * named + 0.5 * s.startswith(("ghp_", "glpat-")) - 0.3 * against >= 0.5 - 1e-9:
                out.append(("secret", m.start(), m.end()))
    for m in re.finditer(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])", text, re.A):
        near = text[max(0, m.start() - 30) : m.start()] + " " + text[m.end() : m.end() + 30]
        score = 0.4 + 0.4 * bool(re.search(r"(?i)\b(?:ssn|social|security|tax|taxpayer|tin)\b", near)) - 0.3 * bool(re.search(r"(?i)\b(?:example|version|isbn|sku|order|test)\b", near))
        if m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000" and score >= 0.5 - 1e-9:
            out.append(("ssn", m.start(), m.end()))
    return sorted(out)


def test_context_decides_for_the_methods_kinds(docs_of):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'token = "{key}"', f"commit {key} of a branch", f"secret example {key}", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", f"password: {key}, {key}.", "SSN 123-45-6789", "number 123-45-6789", "ssn 000-45-6789 and 900-45-6789 123-00-6789",
             "social security 123-45-6789, 321-54-9876 123-45-67890", f"api_key={key} token {'a' * 40} {'1' * 40}", "token " * 3000 + key, f"order test {'x1' * 20}", "secret " + "ab1" * 20000, f"é😀 token {key} 😀"]
    rows = {r["doc_id"]: r for r in pii.spans(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        assert sorted((s["kind"], s["start"], s["end"]) for s in rows[i]["spans"] if s["kind"] in ("ssn", "secret")) == brute_method_spans(t), t[:60]
    assert brute_method_spans(texts[0]) and not brute_method_spans(texts[1]) and brute_method_spans(texts[3]) and len(brute_method_spans(texts[8])) == 2
    counts = {r["doc_id"]: (r["n_secret"], r["n_ssn"], r["n_spans"]) for r in pii.digest(pii.spans(docs_of(texts))).collect()}
    assert counts[0] == (1, 0, 1) and counts[5] == (0, 1, 1) and counts[1][2] == 0


def test_no_python_in_plan(docs_of):
    plan = pii.digest(pii.spans(docs_of(TEXTS)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_iban_before_words_numbers_and_other_ibans(docs_of):
    de, plain, gb = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [f"{plain} Please pay", f"{de} 2024", f"{de} I pay", f"{de} {gb}", f"{plain} {plain} {gb} 1 A", f"{plain}1", f"x{plain}", "NO93 8601 1117 947 Konto"]
    rows = pii.spans(docs_of(texts)).collect()
    found = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == "iban"] for r in rows}
    assert found == {0: [plain], 1: [de], 2: [de], 3: [de, gb], 4: [plain, plain, gb], 5: [], 6: [], 7: ["NO93 8601 1117 947"]}


def test_time_grows_with_the_text(spark, docs_of):
    """Four times the spans take about four times as long, not sixteen; thousands of them take seconds."""
    import time

    def one(i):
        return f"{4111111111111111 if i % 3 == 0 else 1000 + i} a{i}@b.de +49 30 {1000000 + i} and 10.0.{i % 256}.7,"

    took = {}
    for n in (4_000, 4_000, 16_000):
        text = " ".join(map(one, range(n)))
        docs = docs_of([text])
        start = time.time()
        row = pii.digest(pii.spans(docs)).first()
        took[n] = time.time() - start
    assert row["n_email"] == row["n_phone"] == row["n_ip"] == 16_000 and row["n_card"] >= 5_334
    assert hashlib.sha256(brute_spans(text).encode()).hexdigest() == row["base_sha256"]
    assert took[16_000] < 9 * took[4_000] and took[16_000] < 60
