"""SQL counterparts of the queries, for DuckDB. Language models, alignment, tokenizers and page trees have none."""

from __future__ import annotations

from tallyloom.llm.pii import RULES

ORACLE: dict[str, str] = {}

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"'[^\x20\x09-\x0D]+'"

ORACLE["op1_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, {WORD}), []) AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
FROM s LEFT JOIN least l ON l.a = s.doc_id
"""

# The base patterns as the contract gives them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
}
_DIGITS = "regexp_replace(x.f, '[^0-9]', '', 'g')"
_TURNED = "array_to_string(list_transform(string_split(x.f[5:] || x.f[1:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END), '')"
VALID = {
    "email": "true",
    "ip": r"regexp_full_match(x.f, '0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}')",
    "card": f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, length({_DIGITS})), lambda i: (({_DIGITS})[length({_DIGITS}) - i]::INT * (1 + i % 2)) "
    f"- 9 * ((({_DIGITS})[length({_DIGITS}) - i]::INT * (1 + i % 2)) > 9)::INT)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"list_reduce(list_transform(string_split({_TURNED}, ''), lambda c: c::INT), lambda a, c: (a * 10 + c) % 97) = 1",
}


def _pii() -> str:
    found, spans, counts = [], [], []
    for kind, pattern in PATTERNS.items():
        rule = RULES[kind]
        found.append(
            f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{
    's': (length(array_to_string(string_split_regex(t, '{pattern}')[1:i], '')) + length(array_to_string(regexp_extract_all(t, '{pattern}')[1:i - 1], '')))::BIGINT,
    'f': regexp_extract_all(t, '{pattern}')[i]}}), lambda x: {VALID[kind]}) AS k_{kind}"""
        )
        spans.append(
            f"""list_transform(k_{kind}, lambda x: {{'span': '{kind}:' || x.s::VARCHAR || ':' || (x.s + length(x.f))::VARCHAR, 'confidence': ({rule.base} + 15 * regexp_matches(
    lower(substring(t, greatest(x.s + 1 - 40, 1), least(x.s, 40)) || ' ' || substring(t, x.s + 1 + length(x.f), 40)), '{rule.words}')::INT)::VARCHAR}})"""
        )
        counts.append(f"len(k_{kind})::BIGINT AS n_{kind}")
    text = "array_to_string(list_transform({}, lambda x: x.span), ',')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, {", ".join(found)} FROM d),
g AS (SELECT *, list_concat(list_concat({spans[0]}, {spans[1]}), list_concat({spans[2]}, {spans[3]})) AS base, {spans[4]} AS more FROM f)
SELECT doc_id, {", ".join(counts)}, sha256({text.format("base")}) AS base_sha256, {text.format("list_concat(base, more)")} AS spans,
  array_to_string(list_transform(list_concat(base, more), lambda x: x.confidence), ',') AS confidence FROM g
"""


ORACLE["op2_pii"] = _pii()

ORACLE["op3_embedding_near_dedup"] = """
WITH RECURSIVE r AS (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
v AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM r WHERE label IS NOT NULL AND vec_id IS NOT NULL AND e IS NOT NULL
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.id AS ia, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
n AS (SELECT ia, count(*) AS n FROM links GROUP BY ia),
pairs AS (SELECT DISTINCT a, b FROM links),
reach AS (SELECT a, b FROM pairs UNION SELECT q.a, p.b FROM reach q JOIN pairs p ON q.b = p.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT r.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(r.vec_id, coalesce(l.b, r.vec_id)) AS component_id,
  coalesce(r.vec_id = least(r.vec_id, coalesce(l.b, r.vec_id)), false) AS kept
FROM r LEFT JOIN n ON n.ia = r.id LEFT JOIN least l ON l.a = r.vec_id
"""

ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
k AS (SELECT h, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, n AS payload_bytes, sha1(p.h) AS payload_digest, CASE WHEN page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to FROM p LEFT JOIN k USING (h)
"""

ORACLE["op9_source_mix"] = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {WORD})), 0)::BIGINT AS size,
    md5('mix-0:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * words / weight::DOUBLE, source NULLS LAST) AS place FROM w),
c AS (SELECT *, (sum(words) OVER ())::DOUBLE - coalesce(sum(3 * words) OVER before, 0) AS open_words,
    (sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0) AS open_weight FROM o
  WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- Sources in the order of their bound per weight: as long as the share is above the bound, the source stops there.
f AS (SELECT min(place) AS first_open FROM c WHERE open_words * weight / open_weight <= 3 * words),
t AS (SELECT c.source, c.words, CASE WHEN c.place >= f.first_open THEN (SELECT any_value(x.open_words / x.open_weight) FROM c x WHERE x.place = f.first_open) * c.weight
    ELSE 3.0 * c.words END AS target FROM c, f),
q AS (SELECT *, least(floor(target + 0.5)::BIGINT, 3 * words) AS part FROM t),
r AS (SELECT d.doc_id, d.size, q.words AS source_size, round(q.target, 6) AS target, CASE WHEN q.words > 0 THEN q.part // q.words ELSE 0 END AS passes,
    CASE WHEN q.words > 0 THEN q.part % q.words ELSE 0 END AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (size * (passes + (upto < rest AND 2 * (rest - upto) >= size)::INT))::BIGINT AS taken FROM r
"""

ORACLE["op10_chat_perspectives"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM t),
v AS (SELECT DISTINCT conv_id, speaker AS viewer FROM t WHERE speaker <> 'system'),
h AS (SELECT p.*, viewer, place // 64 AS block, speaker = viewer AS own, CASE WHEN speaker = 'system' THEN '<|im_start|>system' || chr(10)
    WHEN speaker = viewer THEN '<|im_start|>assistant' || chr(10)
    ELSE '<|im_start|>user name=' || regexp_replace(replace(speaker, '<|', '<\|'), '[\r\n]', ' ', 'g') || chr(10) END AS head, text || '<|im_end|>' AS body
  FROM p JOIN v USING (conv_id)),
o AS (SELECT *, coalesce(sum(length(head || body) + 1) OVER (PARTITION BY conv_id, viewer, block ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + length(head) AS first FROM h)
SELECT conv_id, viewer AS speaker, block::BIGINT AS block, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
  coalesce(string_agg(first::BIGINT || ':' || (first + length(body))::BIGINT, ',' ORDER BY place) FILTER (own), '') AS mask,
  coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_learn
FROM o GROUP BY conv_id, viewer, block
"""


def _least(*values: str) -> str:
    """The least of ``cost|audit`` values: costs have nine digits, so text order goes by cost, then by audit."""
    return f"least({', '.join(values)})"


def _plus(value: str, cost: str, letters: str) -> str:
    return f"(lpad((({value})[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || ({value})[10:] || '{letters}')"


def _repair() -> str:
    """Forward over the rows of each conversation with the least (cost, audit) that ends in nothing (n), s, u or a."""
    never = "'900000000'"
    to_user = _least("u", _plus("a", "2", "I"), _plus("n", "2", "I"), _plus("s", "2", "I"))
    to_assistant = _least("a", _plus("u", "2", "I"), _plus("n", "4", "II"), _plus("s", "4", "II"))
    closed = f"n, s, {to_user} AS u, {to_assistant} AS a"
    users = [_plus(f"CASE WHEN c = 'u' THEN {p} ELSE {never} END", "cut", "K") for p in "nsa"] + [_plus(p, "2 + cut", "R") for p in "nsa"]
    answers = [_plus(f"CASE WHEN c = 'a' THEN u ELSE {never} END", "cut", "K"), _plus("u", "2 + cut", "R")]
    after = {"n": [], "s": [_plus(f"CASE WHEN c = 's' THEN n ELSE {never} END", "cut", "K")], "u": users, "a": answers}
    moved = ", ".join(f"CASE WHEN goes THEN {_plus(k, '3', 'D')} ELSE {_least(_plus(k, '3', 'D'), *v)} END AS {k}" for k, v in after.items())
    return f"""
WITH RECURSIVE bits AS (SELECT i::BIGINT AS i, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
kinds AS (SELECT raw.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
    lambda r, b: xor(r >> 8, tab[xor(r, b) % 256 + 1])), 4294967295) % 20 AS kind FROM raw, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    list_last(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]')) AS ending FROM damaged),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed),
f AS (SELECT *, left(role, 1) AS c, ending IS NULL AS blank, ending IS NOT NULL AND seen > 1 AS duplicate,
    coalesce(ending NOT IN ('.', '!', '?') AND seen = 1, false) AS truncated,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || '>' || left(role, 1) AS pair FROM told),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('s>u', 'u>a', 'a>u')) AS illegal, max(i) AS size FROM f GROUP BY conv_id),
dp AS (SELECT conv_id, size, 0::BIGINT AS i, '000000000' AS n, {never} AS s, {never} AS u, {never} AS a FROM counted
  UNION ALL SELECT conv_id, size, i, {moved} FROM (
    SELECT conv_id, size, i, c, goes, cut, {closed} FROM (
      SELECT d.conv_id, d.size, f.i, f.c, f.blank OR f.duplicate AS goes, f.truncated::INT AS cut, d.n, d.s, d.u, d.a
      FROM dp d JOIN f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1) x) y),
best AS (SELECT conv_id, least(n, a)[1:9]::BIGINT AS cost, least(n, a)[10:] AS audit FROM (SELECT conv_id, {closed} FROM dp WHERE i = size) x),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS k FROM best WHERE audit <> ''),
steps AS (SELECT *, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS place FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
done AS (SELECT p.*, f.role, f.text, max((place = 1 AND letter = 'K' AND c = 's')::INT) OVER (PARTITION BY p.conv_id) AS lead
  FROM steps p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND letter <> 'I'),
texts AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM done WHERE letter <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""


ORACLE["op13_conversation_repair"] = _repair()

TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLE["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all({LOWER}, {TERM})) AS term FROM documents),
tf AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY row, term),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, {TERM})) AS term FROM benchmark) x),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term),
m AS (SELECT row, 100 - 50 + (50 * n * docs) // terms AS m FROM n, whole),
s AS (SELECT item_id, row, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item_id, row),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
