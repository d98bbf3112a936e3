"""SQL for the queries that SQL can express, written for DuckDB."""

from __future__ import annotations

from ledgerloom.llm.pii import PATTERNS

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

OP3 = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda c: NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM x q JOIN x c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP5 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to,
  '<urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-' || substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1)::INTEGER, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) || '>' AS record_id,
  coalesce(url, '') AS url
FROM (SELECT *, sha256('page|' || page_id) AS h FROM f)
"""

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {WORDS} AS ws FROM d),
e AS (SELECT r, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT r, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS win FROM e WINDOW o AS (PARTITION BY r ORDER BY i)),
t AS (SELECT r, i, win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 AS twice FROM g),
c AS (SELECT r, i, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM t),
rep AS (SELECT r, count(*) FILTER (covered) AS n_repeat_words FROM c GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(text, '[^A-Za-z\x{{C0}}-\x{{10FFFF}}]', '', 'g')) AS letters, len(list_filter(ws, lambda x: x = '|')) AS bars
  FROM w LEFT JOIN rep ON rep.r = w.r LEFT JOIN dup ON dup.r = w.r
), b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) + (CASE WHEN n_words > 0 AND NOT word_chars BETWEEN 2 * n_words AND 15 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END) + (CASE WHEN 10 * capitals > 4 * letters THEN 32 ELSE 0 END) + (CASE WHEN 10 * bars > n_words THEN 64 ELSE 0 END)
    + (CASE WHEN 2 * letters < word_chars THEN 128 ELSE 0 END) AS bits FROM m
)
"""
_OP7 = OP7
OP7 += """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_bits,
  bits & 3 = 0 AS kept_v1, bits & 31 = 0 AS kept_v2, bits = 0 AS kept_v3,
  CASE bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'word_length' WHEN 8 THEN 'symbols' WHEN 16 THEN 'duplicate_lines' WHEN 32 THEN 'capitals' WHEN 64 THEN 'bars' WHEN 128 THEN 'letters' END AS only_rule FROM b
"""
ABLATIONS = _OP7 + """, r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('word_length', 4), ('symbols', 8), ('duplicate_lines', 16), ('capitals', 32), ('bars', 64), ('letters', 128))
SELECT rule, count(*) FILTER (bits & bit <> 0) AS failed, count(*) FILTER (bits = bit) AS only, count(*) FILTER (bits = bit OR bits = 0) AS kept_without FROM b, r GROUP BY 1
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
w AS (SELECT doc_id, {WORDS} AS ws FROM d),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * inter >= 85 * (na.n + nb.n - inter)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other)::BIGINT AS component_id FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# The contract's patterns as they stand; the operator's own are written for a matcher that must not recurse.
_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
assert set(_PII) < set(PATTERNS)
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_TEST = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INTEGER ELSE substr('0246813579', substr(reverse({_DIGITS}), i, 1)::INTEGER + 1, 1)::INTEGER END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}


def _kind(i: int, kind: str) -> str:
    p = _PII[kind].replace("'", "''")
    return rf"""SELECT r, {i} AS rank, '{kind}' AS kind, m, (coalesce(list_sum(list_transform(parts[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM (SELECT r, ms, parts, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT r, regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS parts FROM d)) WHERE {_TEST[kind]}"""


def op9_base() -> str:
    """Counts and the digest of base spans; the method's own spans are left to tests."""
    return "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),\nm AS (" + "\nUNION ALL ".join(_kind(i, k) for i, k in enumerate(_PII)) + r"""),
j AS (SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  string_agg(kind || ':' || s || ':' || (s + length(m)), ',' ORDER BY s, rank) AS spans FROM m GROUP BY r)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS base_spans
FROM d LEFT JOIN j ON j.r = d.r"""


def crc32(s: str) -> str:
    """The unsigned CRC-32 of a string's UTF-8, bit by bit."""
    byte = f"('0x' || substr(hex(encode({s})), 2 * k + 1, 2))::BIGINT"
    return f"xor(4294967295, list_reduce(list_transform(range(octet_length(encode({s}))), lambda k: {byte}), lambda a, b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b)), 4294967295::BIGINT))"


OP11 = rf"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
h AS (SELECT run, n, {crc32("id || ':' || run")} AS h FROM (SELECT id, run, count(*) AS n FROM r GROUP BY ALL)),
e AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
lost AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM lost a JOIN lost b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT w.word, lost.word FROM w JOIN lost ON lost.rest = w.word
  UNION SELECT lost.word, w.word FROM w JOIN lost ON lost.rest = w.word),
near AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS best, max(w.n) AS best_n FROM pairs JOIN w ON w.word = b GROUP BY a),
f AS (SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM w LEFT JOIN near ON near.word = w.word),
chain(word, top, step) AS (SELECT word, word, 0 FROM f UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.top WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(top, step) AS root FROM chain GROUP BY word) c ON c.word = f.word
"""

_S = r"\x20\x09-\x0D"


def _after(state: int, *ways: tuple[str, str, str]) -> str:
    """The best way to a state: of (way so far, cost to add, letter), where a way is its cost in twelve digits and then its edits."""
    return "least(" + ", ".join(f"CASE WHEN {way} IS NOT NULL AND {add} IS NOT NULL THEN printf('%012d', substr({way}, 1, 12)::BIGINT + {add}) || substr({way}, 13) || '{letter}' END" if letter else way for way, add, letter in ways) + f") AS w{state}"


def op12() -> str:
    """Row by row: the cheapest way to each of the four states, first without and then with turns inserted after the row."""
    keep = lambda role: f"CASE WHEN NOT gone AND initial = '{role}' THEN cut END"
    change = "CASE WHEN NOT gone THEN 1 + cut END"
    step = ", ".join((
        _after(0, ("w0", "2", "D")),
        _after(1, ("w1", "2", "D"), ("w0", keep("s"), "K")),
        _after(2, ("w2", "2", "D"), *((f"w{i}", keep("u"), "K") for i in (0, 1, 3)), *((f"w{i}", change, "R") for i in (0, 1, 3))),
        _after(3, ("w3", "2", "D"), ("w2", keep("a"), "K"), ("w2", change, "R"))))
    insert = ", ".join(("w0", "w1", _after(2, ("w2", "0", ""), *((f"w{i}", "5", "I") for i in (0, 1, 3))), _after(3, ("w3", "0", ""), ("w2", "5", "I"))))
    zero = "'000000000000'"
    return rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS c FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role, CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN c = 3 THEN 2 ELSE 1 END)) FROM o WHERE c <> 0),
k AS (SELECT *, coalesce(conv_id::VARCHAR, '') AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, left(role, 1) AS initial FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_S}]') THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][{_S}]*$') THEN 'truncated' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM k),
g AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cut FROM f),
start AS (SELECT id, 0 AS i, {zero} AS w0, NULL::VARCHAR AS w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3 FROM (SELECT DISTINCT id FROM g)),
way(id, i, w0, w1, w2, w3) AS (
  SELECT id, i, {insert} FROM (SELECT id, i, {insert} FROM start)
  UNION ALL SELECT id, i, {insert} FROM (SELECT id, i, {insert} FROM (SELECT way.id, g.i, {step} FROM way JOIN g ON g.id = way.id AND g.i = way.i + 1))),
best AS (SELECT id, least(arg_max(w0, i), arg_max(w3, i)) AS w FROM (SELECT id, i, coalesce(w0, 'x') AS w0, coalesce(w3, 'x') AS w3 FROM way) GROUP BY id),
a AS (SELECT id, substr(w, 1, 12)::BIGINT AS cost, substr(w, 13) AS audit FROM best),
l AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY j) AS i FROM (SELECT id, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS j FROM a)),
p AS (SELECT l.id, j, letter, g.role, coalesce(g.text, '') AS text, coalesce(g.initial, '') AS initial, row_number() OVER (PARTITION BY l.id ORDER BY j) AS place FROM l LEFT JOIN g ON g.id = l.id AND g.i = l.i AND letter <> 'I' WHERE letter <> 'D'),
q AS (SELECT *, coalesce(first(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY place), 0) AS s FROM p),
x AS (SELECT id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS h FROM q GROUP BY id),
n AS (SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS id FROM conversations) c LEFT JOIN n USING (id) LEFT JOIN a USING (id) LEFT JOIN x USING (id)
"""


OP13 = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[{_S}]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER o AS place, first(doc_id) OVER o AS keep_id FROM d WINDOW o AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""


ORACLE_SQL = {"op3_topk": OP3, "op5_warc": OP5, "op7_quality_rules": OP7, "op8_ngram_jaccard": OP8, "quality_rules_ablations": ABLATIONS, "pii_base_spans": op9_base(), "op11_spelling_variants": OP11, "op12_conversation_repair": op12(), "op13_exact_dedup": OP13}
