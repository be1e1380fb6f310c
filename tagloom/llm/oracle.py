"""DuckDB twins of the queries that SQL can express.

Language identification, packing and the pipeline have none; tests hold them against plain Python.
"""

from __future__ import annotations

import math

from tagloom.llm.common import LOWER, TOKEN, UPPER, WORD
from tagloom.llm.lexical_search import TERM
from tagloom.llm.license_scan import TEMPLATES, template_words
from tagloom.llm.quality_rules import COMMON_WORDS, PUNCTUATION
from tagloom.llm.secret_scan import ASSIGN, BASE, MORE
from tagloom.llm.url_filter import RULES, TRACKING


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lower(x: str) -> str:
    return f"translate(coalesce({x}, ''), '{UPPER}', '{LOWER}')"


def strings(items) -> str:
    return "[" + ", ".join(map(q, items)) + "]"


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ op1

_templates = [(k, label, sorted(set(template_words(t)))) for k, (label, t) in enumerate(TEMPLATES)]
_values = ", ".join(f"({k}, {q(label)}, {strings(w)}, {max(1, math.ceil(0.8 * len(w) - 1e-9))})" for k, label, w in _templates)


def _starts(words: list[str]) -> str:
    same = " AND ".join(f"w[i + {k}] = {q(p)}" for k, p in enumerate(words))
    return f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {same}), lambda i: i - 1)"


SQL["op1_license_scan"] = f"""WITH t(tid, label, words, need) AS (VALUES {_values}),
d AS (SELECT row_number() OVER () AS r, doc_id, {lower('text')} AS low FROM documents),
w AS (SELECT r, doc_id, low, regexp_extract_all(low, '{WORD}') AS w FROM d),
s AS (SELECT r, doc_id, low, len(w) AS n, {_starts(['cc', 'by'])} AS s0, {_starts(['general', 'public', 'license'])} AS s1,
  {_starts(['all', 'rights', 'reserved'])} AS s2 FROM w),
b AS (SELECT r, unnest(range(0, len(string_split(low, chr(10))))) AS block, unnest(string_split(low, chr(10))) AS line FROM s),
bw AS (SELECT r, block, list_distinct(regexp_extract_all(line, '{WORD}')) AS ws FROM b),
m AS (SELECT bw.r, bw.block, t.label, len(list_intersect(bw.ws, t.words)) AS shared, len(t.words) AS size FROM bw, t
  WHERE len(list_intersect(bw.ws, t.words)) >= t.need),
g AS (SELECT r, list(DISTINCT label) AS more, max(shared / size) AS best, count(DISTINCT block) AS n_blocks FROM m GROUP BY r),
z AS (SELECT s.r, s.doc_id, s.n, list_concat(list_concat(s0, s1), s2) AS a,
  list_filter([CASE WHEN len(s0) > 0 THEN 'cc-by' END, CASE WHEN len(s1) > 0 THEN 'gpl' END, CASE WHEN len(s2) > 0 THEN 'reserved' END],
    lambda x: x IS NOT NULL) AS base FROM s)
SELECT z.doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(a) AS BIGINT) AS n_base, CAST(list_min(a) AS BIGINT) AS first_word,
  CAST(list_max(a) AS BIGINT) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(a) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score, coalesce(n_blocks, 0) AS n_blocks
FROM z LEFT JOIN g ON z.r = g.r"""

# ------------------------------------------------------------------ op4


def _canonical(url: str) -> str:
    host = f"regexp_replace(regexp_replace({_host(url)}, ':(80|443)$', ''), '^(www|m|mobile)\\.([^.]+\\.)', '\\2')"
    path = f"regexp_replace({_path(url)}, '(/index)?\\.html?$|/+$', '')"
    query = f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1)"
    kept = (f"list_sort(list_filter(string_split({query}, '&'), lambda p: p <> '' AND "
            f"NOT regexp_matches(split_part(p, '=', 1), '(?i)^({TRACKING})$')))")
    return (f"CASE WHEN {host} <> '' THEN concat({host}, {path}, "
            f"CASE WHEN len({kept}) > 0 THEN concat('?', array_to_string({kept}, '&')) ELSE '' END) END")


def _host(url: str) -> str:
    return lower(f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1)")


def _path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


_ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_fits = {(v, h, p): f"(host = {q(h)} OR ends_with(host, {q('.' + h)})) AND starts_with(path, {q(p)})" for v, h, p in _ordered}
_rule = "CASE " + " ".join(f"WHEN {_fits[r]} THEN {q(r[1] + r[2])}" for r in _ordered) + " END"
_verdict = "CASE " + " ".join(f"WHEN {_fits[r]} THEN {q(r[0])}" for r in _ordered) + " WHEN listed THEN 'block' ELSE 'allow' END"
SQL["op4_url_filter"] = f"""WITH c AS (SELECT page_id, url, {_host('url')} AS host, {_path('url')} AS path, {_canonical('url')} AS canonical_url FROM pages),
l AS (SELECT DISTINCT canonical_url AS k FROM c WHERE try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]{{1,18}})', 1) AS BIGINT)
  IN (SELECT doc_id FROM labels WHERE toxic = 1) AND canonical_url IS NOT NULL),
x AS (SELECT c.*, l.k IS NOT NULL AS listed FROM c LEFT JOIN l ON c.canonical_url = l.k)
SELECT page_id, host, path, {_rule} AS rule, {_verdict} AS verdict, canonical_url, listed FROM x"""

# ------------------------------------------------------------------ op5

SQL["op5_ngram_jaccard"] = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({lower('text')}, '{TOKEN}') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
  lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS g FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(c.b, g.doc_id)) AS component_id FROM g LEFT JOIN c ON g.doc_id = c.a"""

# ------------------------------------------------------------------ op6

SQL["op6_decontaminate"] = f"""WITH bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lower('text')}, '{WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT item, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: list_slice(w, i, i + 12))) AS ws FROM bw WHERE len(w) > 0),
ph AS (SELECT array_to_string(ws, ' ') AS phrase, len(ws) AS n, any_value(ws) AS ws, list(DISTINCT item) AS items FROM win GROUP BY ALL),
sizes AS (SELECT DISTINCT n FROM ph),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower('text')}, '{WORD}') AS w FROM documents),
dg AS (SELECT r, s.n, unnest(range(1, len(w) - s.n + 2)) AS i, unnest(list_transform(range(1, len(w) - s.n + 2), lambda i: array_to_string(list_slice(w, i, i + s.n - 1), ' '))) AS g
  FROM d, sizes s WHERE len(w) >= s.n),
hit AS (SELECT dg.r, dg.i, dg.n, ph.items FROM dg JOIN ph ON dg.g = ph.phrase AND dg.n = ph.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM (SELECT r, unnest(items) AS item FROM hit) GROUP BY r),
tok AS (SELECT r, unnest(range(0, len(w))) AS p, unnest(w) AS term FROM d),
df AS (SELECT term, count(DISTINCT r) AS df FROM tok GROUP BY term),
pl AS (SELECT phrase, unnest(range(0, len(ws))) AS o, unnest(ws) AS term FROM ph),
rk AS (SELECT pl.*, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(df, 0), pl.term, o) AS k, min(coalesce(df, 0)) OVER (PARTITION BY phrase) AS least,
  count(*) OVER (PARTITION BY phrase) AS places FROM pl LEFT JOIN df ON pl.term = df.term),
sh AS (SELECT tok.r, rk.phrase, rk.o, tok.p - rk.o AS s FROM rk JOIN tok ON tok.term = rk.term WHERE rk.k <= 2 AND rk.least > 0 AND rk.places > 1),
near AS (SELECT DISTINCT a.r, a.phrase, a.s FROM sh a JOIN sh b ON a.r = b.r AND a.phrase = b.phrase AND a.o <> b.o AND b.s - a.s BETWEEN 1 AND 3),
nn AS (SELECT r, count(*) AS n_near FROM near GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN pos ON d.r = pos.r LEFT JOIN it ON d.r = it.r LEFT JOIN nn ON d.r = nn.r"""

# ------------------------------------------------------------------ op7

SQL["op7_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN f ON p.h = f.h"""

# ------------------------------------------------------------------ op8

SQL["op8_perspective_rotation"] = """WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS x FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
s AS (SELECT t.*, who.participant, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = participant THEN 'assistant' ELSE 'user' END AS as_role
  FROM t JOIN who ON t.conv_id = who.conv_id),
h AS (SELECT *, concat('<|im_start|>', as_role, CASE WHEN as_role = 'user' THEN concat(' name=', speaker) ELSE '' END, chr(10)) AS head FROM s),
g AS (SELECT *, concat(head, x, '<|im_end|>', chr(10)) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER w AS z, row_number() OVER w - 1 AS seq FROM g
  WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, x ROWS UNBOUNDED PRECEDING))
SELECT conv_id, participant, seq, turn, speaker, as_role, segment, CAST(z - length(segment) AS BIGINT) AS start, CAST(z AS BIGINT) AS "end",
  CAST(CASE WHEN as_role = 'assistant' THEN z - length(segment) + length(head) END AS BIGINT) AS mask_start,
  CAST(CASE WHEN as_role = 'assistant' THEN z - 1 END AS BIGINT) AS mask_end FROM e"""

# ------------------------------------------------------------------ op9

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_lists = "CASE lang " + " ".join(f"WHEN {q(k)} THEN {strings(v)}" for k, v in COMMON_WORDS.items()) + " END"


def _js(p: str, r: str) -> str:
    def term(a: str) -> str:
        m = f"(({p}[i] / list_sum({p})) + ({r}[i] / list_sum({r}))) / 2"
        return f"CASE WHEN {a}[i] > 0 THEN ({a}[i] / list_sum({a})) * log2(({a}[i] / list_sum({a})) / ({m})) ELSE 0.0::DOUBLE END"

    return f"sqrt(greatest(0.0::DOUBLE, list_sum(list_transform(range(1, len({p}) + 1), lambda i: ({term(p)} + {term(r)}) / 2))))"


SQL["op9_quality_rules"] = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{TOKEN}') AS w, translate(t, {_SPACES}, '') AS solid,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{TOKEN}')) AS lines, {_lists} AS words FROM d),
grams AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g FROM w WHERE len(w) > 2),
again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, len(w) AS n_words, length(solid) AS word_chars, length(solid) - length(translate(solid, '#*$%&|<>', '')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  length(t) - length(regexp_replace(t, '\\p{{L}}', '', 'g')) AS letters, length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS upper,
  length(t) - length(regexp_replace(t, '\\p{{Nd}}', '', 'g')) AS digits, length(t) - length(solid) AS spaces, length(t) AS n,
  list_transform(words, lambda x: len(list_filter(list_transform(w, lambda z: trim(translate(z, {q(UPPER)}, {q(LOWER)}), {q(PUNCTUATION)})), lambda y: y = x))) AS hist FROM w LEFT JOIN rep ON w.r = rep.r),
h AS (SELECT *, [letters - upper, upper, digits, spaces, n - letters - digits - spaces] AS cls,
  list_concat(hist, [n_words - list_sum(hist)]) AS wrd FROM c),
x AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed, length(bin(n_words)) AS band FROM h),
u AS (SELECT DISTINCT lang, band, cls, wrd FROM x WHERE NOT failed),
ref AS (SELECT lang, [{', '.join(f'sum(cls[{i}] * 1000000 // list_sum(cls))' for i in range(1, 6))}] AS rc,
  CASE WHEN count(wrd) > 0 THEN [{', '.join(f'sum(wrd[{i}] * 1000000 // list_sum(wrd))' for i in range(1, 14))}] END AS rw FROM u GROUP BY lang),
ud AS (SELECT u.lang, band, {_js('cls', 'rc')} AS cd, CASE WHEN wrd IS NOT NULL THEN {_js('wrd', 'rw')} END AS wd FROM u JOIN ref ON u.lang IS NOT DISTINCT FROM ref.lang),
b AS (SELECT lang, band, quantile_cont(floor(cd * 1000), 0.25) AS c1, quantile_cont(floor(cd * 1000), 0.75) AS c3,
  quantile_cont(floor(wd * 1000), 0.25) AS w1, quantile_cont(floor(wd * 1000), 0.75) AS w3 FROM ud GROUP BY lang, band),
j AS (SELECT x.*, CASE WHEN n_words >= 50 THEN {_js('cls', 'rc')} END AS cd, CASE WHEN n_words >= 50 AND wrd IS NOT NULL THEN {_js('wrd', 'rw')} END AS wd
  FROM x LEFT JOIN ref ON x.lang IS NOT DISTINCT FROM ref.lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed AS base_failed,
  round(cd, 6) AS class_distance, round(wd, 6) AS word_distance,
  NOT failed AND NOT (coalesce(cd > (c3 + 3 * greatest(c3 - c1, 30)) / 1000, FALSE) OR coalesce(wd > (w3 + 3 * greatest(w3 - w1, 30)) / 1000, FALSE)) AS kept
FROM j LEFT JOIN b ON j.lang IS NOT DISTINCT FROM b.lang AND j.band = b.band"""

# ------------------------------------------------------------------ op10


def _found(n: int, pattern: str) -> str:
    return (f"SELECT r, doc_id, source, {n} AS kind, regexp_extract_all(t, {q(pattern)}) AS m, regexp_split_to_array(t, {q(pattern)}) AS g "
            f"FROM d WHERE regexp_matches(t, {q(pattern)})")


_patterns = [p for _, p, _ in BASE] + [p for _, p, _ in MORE]
_names = strings([k for k, *_ in BASE] + [k for k, *_ in MORE])
_least = "[" + ", ".join([str(n) for *_, n in BASE] + ["0"] * len(MORE)) + "]"
SQL["op10_secret_scan"] = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(_found(n, p) for n, p in enumerate(_patterns))}),
e AS (SELECT r, doc_id, source, kind, unnest(range(1, len(m) + 1)) AS k, m, g FROM f),
s AS (SELECT r, doc_id, source, kind, m[k] AS hit, CAST(list_sum(list_transform(list_slice(g, 1, k), lambda x: length(x)))
  + coalesce(list_sum(list_transform(list_slice(m, 1, k - 1), lambda x: length(x))), 0) AS BIGINT) AS a FROM e),
v AS (SELECT r, doc_id, source, kind, a, a + length(hit) AS z, CASE WHEN kind = 0 THEN regexp_extract(hit, {q(ASSIGN)}, 1) ELSE hit END AS v FROM s),
o AS (SELECT * FROM v WHERE length(v) >= {_least}[kind + 1]),
n AS (SELECT v, count(DISTINCT source) AS owners FROM o GROUP BY v),
x AS (SELECT o.*, n.owners, concat({_names}[kind + 1], ':', a, ':', z) AS label FROM o JOIN n ON o.v = n.v),
y AS (SELECT r, string_agg(label, ',' ORDER BY a, kind, label) AS spans, string_agg(label, ',' ORDER BY a, kind, label) FILTER (WHERE kind < 3) AS base,
  count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2,
  count(*) FILTER (WHERE owners < 4) AS live, count(*) FILTER (WHERE owners >= 4) AS example FROM x GROUP BY r)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(live, 0) AS n_live, coalesce(example, 0) AS n_example FROM d LEFT JOIN y ON d.r = y.r"""

# ------------------------------------------------------------------ op11

SQL["op11_lexical_search"] = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower('text')}, '{TERM}') AS w FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM tf, s GROUP BY term, n_docs),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all({lower('text')}, '{TERM}') AS w FROM benchmark),
a AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
x AS (SELECT a.i, a.item_id, d.r, d.doc_id, CAST(sum(a.times * wt.wt * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.w) * s.n_docs) // s.n_terms))))
  AS BIGINT) AS score FROM a JOIN tf ON tf.term = a.term JOIN wt ON wt.term = a.term JOIN d ON d.r = tf.r, s GROUP BY a.i, a.item_id, d.r, d.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20"""

# ------------------------------------------------------------------ op13
# Damage by a CRC-32 of SQL's own, then a DP from the last row to the first that carries (cost, audit, lines) per state.

_NONE = "{'c': 1000000000::BIGINT, 'a': '', 'l': ''}"
_SPACE = r"\x20\x09-\x0D"


def _edit(cost: str, letter: str, line: str, to: str) -> str:
    return f"{{'c': ({cost}) + {to}.c, 'a': '{letter}' || {to}.a, 'l': {line} || {to}.l}}"


def _read(s: str, initials: dict[str, str], inserted: str) -> str:
    """The best way from state ``s`` over the row to the states behind it."""
    keep = " ".join(f"WHEN k.h = '{h}' THEN {_edit('k.x', 'K', 'k.line', to)}" for h, to in initials.items())
    role = {"s2": "user", "s3": "assistant"}[inserted]
    reroled = _edit("1 + k.x", "R", f"chr(10) || '{role}:' || k.text", "r." + inserted)
    return (f"list_sort([{_edit('2', 'D', chr(39) * 2, 'r.' + s)}, CASE WHEN k.gone THEN {_NONE} {keep} ELSE {_NONE} END, "
            f"CASE WHEN k.gone THEN {_NONE} ELSE {reroled} END])[1]")


def _insert(role: str, to: str) -> str:
    return _edit("5", "I", f"chr(10) || '{role}:'", to)


SQL["op13_conversation_repair"] = f"""WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
  ORDER BY n) AS tab FROM range(256) AS t(n)),
o AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
f AS (SELECT o.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT),
  lambda s, b: xor(s >> 8, tab[(xor(s, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS fate FROM o, crc),
d AS (SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) FROM f WHERE fate <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
k0 AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][{_SPACE}]*$') THEN 'truncated' ELSE 'ok' END AS fault, left(role, 1) AS h,
  chr(10) || role || ':' || text AS line, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS g FROM p),
k AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS x FROM k0),
n AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND g || h NOT IN ('su', 'ua', 'au')) AS illegal FROM k GROUP BY c),
r AS (SELECT c, n + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'l': ''}} AS s0, {{'c': 10::BIGINT, 'a': 'II', 'l': concat(chr(10), 'user:', chr(10), 'assistant:')}} AS s1,
    {{'c': 5::BIGINT, 'a': 'I', 'l': concat(chr(10), 'assistant:')}} AS s2, {{'c': 0::BIGINT, 'a': '', 'l': ''}} AS s3 FROM n
  UNION ALL
  SELECT c, i, list_sort([w0, {_insert('user', 't2')}])[1], list_sort([w1, {_insert('user', 't2')}])[1], t2, t3
  FROM (SELECT *, list_sort([w2, {_insert('assistant', 'w3')}])[1] AS t2, list_sort([w3, {_insert('user', 'w2')}])[1] AS t3
    FROM (SELECT r.c, k.i, {_read('s0', {'s': 'r.s1', 'u': 'r.s2'}, 's2')} AS w0, {_read('s1', {'u': 'r.s2'}, 's2')} AS w1,
      {_read('s2', {'a': 'r.s3'}, 's3')} AS w2, {_read('s3', {'u': 'r.s2'}, 's2')} AS w3
      FROM r JOIN k ON k.c = r.c AND k.i = r.i - 1))),
best AS (SELECT c, s0 FROM r WHERE i = 1)
SELECT u.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(substr(s0.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM o) u LEFT JOIN n ON n.c = u.c LEFT JOIN best ON best.c = u.c"""
