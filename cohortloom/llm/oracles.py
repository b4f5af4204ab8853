"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

HOST_RULES = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
n AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r),
k AS (
  SELECT r, i, CASE WHEN count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) = 5
    THEN string_agg(w, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) END AS g FROM w),
c AS (SELECT r, i, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 THEN 1 ELSE 0 END AS again FROM k),
h AS (SELECT r, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM c),
rep AS (SELECT r, sum(hit) AS n_repeat_words FROM h GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, d.source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN n USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    10 * n_symbols > word_chars AS symbols_failed, 2 * n_dup_lines > n_lines AS lines_failed,
    [n_words < 10 OR 100 * n_repeat_words > 15 * n_words, 15 * n_symbols > word_chars, 3 * n_dup_lines > n_lines] AS strict FROM m),
hosts AS (SELECT source, count(*) AS n, unnest([sum(base_failed::INT), sum(symbols_failed::INT), sum(lines_failed::INT)]) AS k, unnest([1, 2, 3]) AS rule FROM f GROUP BY source),
mo AS (SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS var FROM hosts GROUP BY rule),
st AS (SELECT *, CASE WHEN var > 0 THEN least(1000.0, greatest(2.0, mean * (1 - mean) / var - 1)) ELSE 1000.0 END AS strength FROM mo),
post AS (SELECT source, rule, mean, (k + strength * mean) / (n + strength) AS rate, n + strength + 1 AS weight FROM hosts JOIN st USING (rule)),
bad AS (SELECT DISTINCT source FROM post WHERE rate > 0.5),
doubted AS (SELECT source, list(rule) AS rules FROM post WHERE rate - mean > sqrt(rate * (1 - rate) / weight) GROUP BY source)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR symbols_failed OR lines_failed OR EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source)
    OR EXISTS (SELECT 1 FROM doubted d, unnest(d.rules) r(rule) WHERE d.source IS NOT DISTINCT FROM f.source AND strict[rule])) AS kept
FROM f
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {ASCII_LOWER.format("coalesce(text, '')")} AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d)),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(10, len(ws)) AS size, array_to_string(ws[p + 1 : p + least(10, len(ws))], ' ') AS g
  FROM (SELECT item, ws, unnest(range(greatest(len(ws) - 9, 1))) AS p FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT r, p AS i, size, array_to_string(ws[p + 1 : p + size], ' ') AS g FROM (
    SELECT r, ws, size, unnest(range(len(ws) - size + 1)) AS p
    FROM (SELECT r, list(w ORDER BY i) AS ws FROM w GROUP BY r), sizes WHERE len(ws) >= size)),
hit AS (SELECT r, i, dw.size, item FROM dw JOIN bw ON dw.size = bw.size AND dw.g = bw.g),
words AS (SELECT DISTINCT r, unnest(range(i, i + size)) AS i FROM hit),
nh AS (SELECT r, count(*) AS n_hit FROM words GROUP BY r),
ni AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r),
nw AS (SELECT r, count(*) AS n_words FROM w GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nw USING (r) LEFT JOIN nh USING (r) LEFT JOIN ni USING (r)
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, text, regexp_extract_all({ASCII_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 OR ws IS NULL THEN [] ELSE
    list_sort(list_distinct([array_to_string(ws[p + 1 : p + 5], ' ') for p in range(greatest(len(ws) - 4, 1))])) END AS sh,
    text FROM w),
k AS (SELECT doc_id, sh, CASE WHEN text IS NULL THEN 'null ' || doc_id WHEN len(sh) = 0 THEN 'text ' || text ELSE 'set ' || md5(array_to_string(sh, '|')) END AS k FROM s),
c AS (SELECT k, min(doc_id) AS copy_of, count(*) AS n_copies, first(sh) AS sh FROM k GROUP BY k),
g AS (SELECT k, len(sh) AS n, unnest(sh) AS g FROM c),
p AS (
  SELECT a.k AS a, b.k AS b FROM g a JOIN g b ON a.g = b.g AND a.k < b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT k AS a, k AS b FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
cl AS (SELECT reach.a AS k, min(c.copy_of) AS class_id FROM reach JOIN c ON c.k = reach.b GROUP BY reach.a),
n AS (SELECT a AS k, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, copy_of, n_copies
FROM k JOIN c USING (k) JOIN cl USING (k) LEFT JOIN n USING (k)
"""

def _leaf(columns: dict[str, str]) -> str:
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR END" for v in columns.values()]
    return f"sha256({' || '.join(parts)})"


_FIELDS = {c: c for c in ("doc_id", "source", "lang", "n_chars", "text")}
# Unsigned CRC-32 of the decimal digits of doc_id, a bit at a time (reflected polynomial 0xEDB88320).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(8 * length(doc_id::VARCHAR)),
  lambda i: ((ascii((doc_id::VARCHAR)[(i // 8 + 1)::INT]) >> (i % 8)::INT) & 1)::BIGINT)),
  lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

MERKLE_MANIFEST = rf"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf(_FIELDS)} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf(_FIELDS | {"n_chars": "n_chars::HUGEINT + 1"})} END AS claim FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS total FROM l),
up AS (
  SELECT lang, 0 AS lev, pos, total, leaf AS h FROM p
  UNION ALL
  SELECT lang, lev + 1, pos // 2, (total + 1) // 2, sha256(h || coalesce(nxt, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY pos) AS nxt FROM up WHERE total > 1) WHERE pos % 2 = 0),
subs AS (SELECT lang, lev, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS total FROM up WHERE total = 1),
top AS (
  SELECT 0 AS lev, pos, total, h FROM subs
  UNION ALL
  SELECT lev + 1, pos // 2, (total + 1) // 2, sha256(h || coalesce(nxt, ''))
  FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS nxt FROM top WHERE total > 1) WHERE pos % 2 = 0),
root AS (SELECT h AS root FROM top WHERE total = 1),
one AS (
  SELECT r, lang, 0 AS lev, pos, total, coalesce(claim, leaf) AS f, '' AS proof FROM p
  UNION ALL
  SELECT o.r, o.lang, o.lev + 1, o.pos // 2, (o.total + 1) // 2,
    sha256(CASE WHEN o.pos % 2 = 1 THEN u.h || f ELSE f || coalesce(u.h, '') END), proof || coalesce(u.h, '')
  FROM one o LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM o.lang AND u.lev = o.lev AND u.pos = xor(o.pos, 1) WHERE o.total > 1),
two AS (
  SELECT o.r, 0 AS lev, s.pos, s.total, s.h AS subroot, f, proof FROM one o JOIN subs s ON s.lang IS NOT DISTINCT FROM o.lang WHERE o.total = 1
  UNION ALL
  SELECT o.r, o.lev + 1, o.pos // 2, (o.total + 1) // 2, subroot,
    sha256(CASE WHEN o.pos % 2 = 1 THEN t.h || f ELSE f || coalesce(t.h, '') END), proof || coalesce(t.h, '')
  FROM two o LEFT JOIN top t ON t.lev = o.lev AND t.pos = xor(o.pos, 1) WHERE o.total > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM two JOIN l USING (r), root WHERE two.total = 1
"""

_P = "1 + (1000000000::HUGEINT * ({c} + 1)) // ({n} + v)"

GROUP_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, {ASCII_LOWER.format("coalesce(text, '')")} AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(term) AS v, coalesce(sum(total), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN cells USING (lang, source) GROUP BY lang, source),
dense AS (SELECT g.lang, g.source, term, kept.total, coalesce(c, 0) AS c, v, {_P.format(c="coalesce(c, 0)", n="g.n")} AS p, {_P.format(c="kept.total", n="langs.n")} AS q
  FROM g JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN cells USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
allpairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM allpairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM dense WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": NGRAM_JOIN,
    "op6_host_rules": HOST_RULES,
    "op7_decontamination": DECONTAMINATION,
    "op12_group_divergence": GROUP_DIVERGENCE,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
