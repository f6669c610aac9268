"""DuckDB SQL of the registered queries of this package that SQL can express.

Not among them are XXH64 of shingles, compression, learned scores, tokenisation, draws from a hash that DuckDB lacks, a
knapsack and minimum cuts; their tests compare with brute force.
"""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"

_OP4 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, regexp_extract_all(t, {_WORD}) AS ws FROM docs),
windows AS (
  SELECT r, s, count(*) OVER (PARTITION BY r, ws[s:s + 7]) AS n
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS s FROM words)),
inside AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS i FROM windows WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(DISTINCT line) AS d
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, {_WORD}) GROUP BY r),
m AS (
  SELECT r, doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
    coalesce(lines.n - lines.d, 0) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words
  FROM docs JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN inside USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
rules(rule, low_too) AS (VALUES ('symbols', false), ('dup_lines', false), ('repeats', false), ('word_length', true)),
vals AS (
  SELECT r, lang, source, base_failed, rule, CASE rule
      WHEN 'symbols' THEN CASE WHEN n_words = 0 THEN 0 ELSE n_symbols * 10000 // n_words END
      WHEN 'dup_lines' THEN CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines * 10000 // n_lines END
      WHEN 'repeats' THEN CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words * 10000 // n_words END
      ELSE CASE WHEN n_words = 0 THEN 0 ELSE word_chars * 10000 // n_words END END AS v
  FROM judged, rules),
tops AS (
  SELECT *, greatest(length(bin(v)) - 7, 0) AS sh FROM vals WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, rule, ((v // (1 << sh)) + 1) * (1 << sh) - 1 AS top, count(*) AS n FROM tops GROUP BY ALL),
parts AS (SELECT *, false AS above FROM sketch UNION ALL SELECT *, true FROM sketch WHERE top > 0),
upto AS (
  SELECT above, lang, source, rule, top,
    sum(n) OVER (PARTITION BY above, lang, source, rule) AS g, sum(n) OVER (PARTITION BY above, lang, source, rule ORDER BY top) AS gu,
    sum(n) OVER (PARTITION BY above, lang, rule) AS l, sum(n) OVER (PARTITION BY above, lang, rule ORDER BY top) AS lu,
    sum(n) OVER (PARTITION BY above, rule) AS a, sum(n) OVER (PARTITION BY above, rule ORDER BY top) AS au
  FROM parts),
gq AS (
  SELECT above, lang, source, rule, max(g) AS n, min(top) FILTER (WHERE 10 * gu >= g) AS q1, min(top) FILTER (WHERE 10 * gu >= 5 * g) AS q5,
    min(top) FILTER (WHERE 10 * gu >= 9 * g) AS q9 FROM upto GROUP BY ALL),
lq AS (
  SELECT above, lang, rule, max(l) AS n, min(top) FILTER (WHERE 10 * lu >= l) AS q1, min(top) FILTER (WHERE 10 * lu >= 5 * l) AS q5,
    min(top) FILTER (WHERE 10 * lu >= 9 * l) AS q9 FROM upto GROUP BY ALL),
aq AS (
  SELECT above, rule, min(top) FILTER (WHERE 10 * au >= a) AS q1, min(top) FILTER (WHERE 10 * au >= 5 * a) AS q5,
    min(top) FILTER (WHERE 10 * au >= 9 * a) AS q9 FROM upto GROUP BY ALL),
chosen AS (
  SELECT o.lang, o.source, o.rule, s.above, CASE WHEN gq.n >= 100 THEN gq.q1 WHEN lq.n >= 100 THEN lq.q1 ELSE aq.q1 END AS q1,
    CASE WHEN gq.n >= 100 THEN gq.q5 WHEN lq.n >= 100 THEN lq.q5 ELSE aq.q5 END AS q5,
    CASE WHEN gq.n >= 100 THEN gq.q9 WHEN lq.n >= 100 THEN lq.q9 ELSE aq.q9 END AS q9
  FROM (SELECT DISTINCT lang, source, rule FROM sketch) o CROSS JOIN (VALUES (false), (true)) s(above)
  LEFT JOIN gq ON gq.above = s.above AND gq.lang IS NOT DISTINCT FROM o.lang AND gq.source IS NOT DISTINCT FROM o.source AND gq.rule = o.rule
  LEFT JOIN lq ON lq.above = s.above AND lq.lang IS NOT DISTINCT FROM o.lang AND lq.rule = o.rule
  LEFT JOIN aq ON aq.above = s.above AND aq.rule = o.rule),
q AS (
  SELECT u.lang, u.source, u.rule, u.q1, u.q5, u.q9, low_too, 1 << greatest(length(bin(u.q5)) - 7, 0) AS width
  FROM chosen w JOIN chosen u ON u.lang IS NOT DISTINCT FROM w.lang AND u.source IS NOT DISTINCT FROM w.source AND u.rule = w.rule AND u.above = (w.q5 = 0)
  JOIN rules ON rules.rule = w.rule WHERE NOT w.above),
broken AS (
  SELECT DISTINCT r FROM vals JOIN q ON q.lang IS NOT DISTINCT FROM vals.lang AND q.source IS NOT DISTINCT FROM vals.source AND q.rule = vals.rule
  WHERE v > q5 + 6 * greatest(q5 - q1, width) OR (low_too AND v < q5 - 6 * greatest(q9 - q5, q5 - q1, width)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM broken) AS kept
FROM judged"""

_OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
result AS (
  SELECT vec_id, coalesce(c.n, 0) AS n_links, least(vec_id, coalesce(l.y, vec_id)) AS component_id
  FROM embeddings LEFT JOIN counts c ON c.x = vec_id LEFT JOIN least l ON l.x = vec_id)
SELECT *, coalesce(vec_id = component_id, false) AS kept FROM result"""

_OP6 = rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
windows AS (SELECT doc_id, s, ws[s:s + 12] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM words)),
firsts AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i
  FROM windows JOIN firsts USING (k) WHERE d < doc_id),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM words) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# DuckDB has no crc32: its table of 256 entries comes from the polynomial
_CRC = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b:
    CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t)"""
_CRC_OF = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen({0})),
    lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)))"""

_OP11 = rf"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT *, {_CRC_OF.format("(doc_id || ':' || r)")} AS h FROM runs, crc WHERE length(r) >= 7),
vocabulary AS (
  SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS w, n FROM hashed)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
cut AS (SELECT w, n, i, w[:i] || w[i + 2:] AS c FROM (SELECT w, n, unnest(range(length(w))) AS i FROM vocabulary)),
near AS (
  SELECT DISTINCT a.w AS x, b.w AS y, b.n AS m FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.w <> b.w
  UNION SELECT cut.w, v.w, v.n FROM cut JOIN (SELECT w, n FROM vocabulary) v ON v.w = cut.c
  UNION SELECT v.w, cut.w, cut.n FROM cut JOIN (SELECT w, n FROM vocabulary) v ON v.w = cut.c),
best AS (SELECT x, count(*) AS n_near, max(m) AS m FROM near GROUP BY x),
formed AS (
  SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN m END AS form_n,
    CASE WHEN m >= 10 * n THEN (SELECT min(y) FROM near WHERE near.x = w AND near.m = best.m) END AS form
  FROM vocabulary LEFT JOIN best ON x = w),
ways AS (
  SELECT w, coalesce(form, w) AS top FROM formed
  UNION SELECT ways.w, form FROM ways JOIN formed ON formed.w = top WHERE form IS NOT NULL),
roots AS (SELECT ways.w, top FROM ways JOIN formed ON formed.w = top WHERE form IS NULL)
SELECT w AS word, form, top AS root, n, n_near, form_n FROM formed JOIN roots USING (w)"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

_OP13 = rf"""
WITH RECURSIVE {_CRC},
docs AS (SELECT *, {_CRC_OF.format("CAST(doc_id AS VARCHAR)")} AS crc FROM documents, crc),
leaves AS (
  SELECT doc_id, lang, {_LEAF.format("n_chars")} AS leaf, {_LEAF.format("CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS altered
  FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, pos // 2),
ways AS (
  SELECT doc_id, leaf, altered, lang, pos, pos AS at, n, 0 AS level, '' AS proof, altered AS x FROM placed
  UNION ALL
  SELECT w.doc_id, w.leaf, w.altered, w.lang, w.pos, w.at // 2, (w.n + 1) // 2, w.level + 1, w.proof || coalesce(s.h, ''),
    CASE WHEN w.at % 2 = 0 THEN sha256(w.x || coalesce(s.h, '')) ELSE sha256(s.h || w.x) END
  FROM ways w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.pos = xor(w.at, 1) WHERE w.n > 1),
upper AS (
  SELECT doc_id, leaf, subroot, w.lang, w.pos AS pos, s.pos AS at, s.n AS n, 0 AS level, proof, x
  FROM ways w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.lang, w.pos, w.at // 2, (w.n + 1) // 2, w.level + 1, w.proof || coalesce(s.h, ''),
    CASE WHEN w.at % 2 = 0 THEN sha256(w.x || coalesce(s.h, '')) ELSE sha256(s.h || w.x) END
  FROM upper w LEFT JOIN tops s ON s.level = w.level AND s.pos = xor(w.at, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = h AS verified
FROM upper JOIN (SELECT h FROM tops WHERE n = 1) ON upper.n = 1"""

ORACLE: dict[str, str] = {
    "op4_rules": _OP4,
    "op5_embeddings": _OP5,
    "op6_substrings": _OP6,
    "op11_spelling": _OP11,
    "op13_manifest": _OP13,
}
