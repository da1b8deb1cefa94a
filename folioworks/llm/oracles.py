"""DuckDB SQL for the operators that plain SQL can express. It follows the definitions, not the methods."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_SECRETS = r"""
WITH kinds(kind, name, pattern, grp, least) AS (VALUES
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]{16,}', 0, 0), (2, 'hex', '[0-9a-f]{24,}', 0, 0),
  (3, 'token', '[A-Za-z0-9+/_-]{20,}', 0, 0)),
texts AS (
  SELECT doc_id, coalesce(source, 'null of all') AS owner, coalesce(text, '') AS text FROM documents),
found AS (
""" + "\n  UNION ALL ".join(
    rf"""SELECT doc_id, owner, {n} AS kind, string_split_regex(text, '{pattern}') AS gaps,
    regexp_extract_all(text, '{pattern}', 0) AS hits, regexp_extract_all(text, '{pattern}', {group}) AS vals FROM texts"""
    for n, (pattern, group) in enumerate((
        (r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2),
        ("AKIA[A-Z0-9]{16,}", 0), ("[0-9a-f]{24,}", 0), ("[A-Za-z0-9+/_-]{20,}", 0)))
) + r"""),
matched AS (
  SELECT doc_id, owner, kind, i, length(gaps[i]) AS gap, length(hits[i]) AS chars, hits[i] AS hit, vals[i] AS val
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
placed AS (
  SELECT *, sum(gap + chars) OVER (PARTITION BY doc_id, kind ORDER BY i) AS "end" FROM matched),
spans AS (
  SELECT doc_id, owner, kind, CAST("end" - chars AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", val FROM placed
  WHERE CASE WHEN kind = 3 THEN regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')
    AND regexp_matches(hit, '[0-9]') AND len(list_distinct(string_split(hit, ''))) >= 12
    ELSE length(val) >= CASE kind WHEN 0 THEN 6 ELSE 0 END END),
seen AS (SELECT val, count(DISTINCT owner) AS owners FROM spans GROUP BY val),
kept AS (
  SELECT spans.*, owners, owners <= 1 AS live FROM spans JOIN seen USING (val)
  WHERE kind < 3 OR NOT EXISTS (FROM spans b WHERE b.doc_id = spans.doc_id
    AND b.kind < 3 AND b.start < spans."end" AND b."end" > spans.start)),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_token, count(*) FILTER (live) AS n_live,
    count(*) FILTER (owners > 1) AS n_shared,
    string_agg(concat_ws(':', name, start, "end"), ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(concat_ws(':', name, start, "end"), ',' ORDER BY start, kind) AS spans,
    string_agg(concat_ws(':', name, start, "end"), ',' ORDER BY start, kind) FILTER (live) AS live_spans
  FROM kept JOIN kinds USING (kind) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(n_token, 0) AS n_token, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live_spans, '') AS live_spans
FROM texts LEFT JOIN listed USING (doc_id)"""

_STRINGS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 99)) AS s FROM texts),
named AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS name FROM places),
earliest AS (SELECT name, min(row(doc_id, s)) AS e FROM named GROUP BY name HAVING count(*) > 1),
hits AS (SELECT doc_id, s FROM named JOIN earliest USING (name) WHERE row(doc_id, s) > e),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 100)) AS p FROM hits),
edges AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM gone),
counted AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (q IS NULL OR q < p - 1) AS n_spans FROM edges GROUP BY doc_id),
bytes AS (SELECT doc_id, substr(h, 2 * p + 1, 2) AS byte, p
  FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT))) AS p FROM texts SEMI JOIN counted USING (doc_id))),
kept AS (SELECT doc_id, string_agg(byte, '' ORDER BY p) AS left_ FROM bytes ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(left_, '') END)) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_PASSAGES = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
named AS (SELECT doc_id, s, md5_number(array_to_string(ws[s:s + 49], ' ')) AS name
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM texts)),
earliest AS (SELECT name, min(doc_id) AS d FROM named GROUP BY name HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM named JOIN earliest USING (name) WHERE doc_id > d),
edges AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM gone),
counted AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (q IS NULL OR q < p - 1) AS n_spans FROM edges GROUP BY doc_id),
said AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS left_ FROM said ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(left_, '')) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_NEAR = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{_WORD}') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, md5_number(array_to_string(ws[s:s + 4], ' ')) AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS s FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (x) WHERE a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes sa ON a = sa.doc_id JOIN sizes sb ON b = sb.doc_id
  WHERE 100 * shared.n >= 85 * (sa.n + sb.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT reach.a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reach.b) AS component_id,
  reach.a = min(reach.b) AS kept
FROM reach LEFT JOIN sizes ON reach.a = sizes.doc_id GROUP BY reach.a"""

_LINES = rf"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS line FROM split),
said AS (SELECT *, regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t FROM raw),
lines AS (SELECT doc_id, line, t, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS "at",
  lead(t) OVER w AS t2, lead(line) OVER w AS line2 FROM said WHERE t <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
singles AS (SELECT doc_id, line, row(doc_id, "at") > min(row(doc_id, "at")) OVER (PARTITION BY t)
  AND len(regexp_extract_all(t, '{_WORD}')) >= 10 AS again FROM lines),
pairs AS (SELECT doc_id, line, line2, row(doc_id, "at") > min(row(doc_id, "at")) OVER (PARTITION BY t, t2) AS again
  FROM lines WHERE t2 IS NOT NULL),
gone AS (SELECT doc_id, line FROM singles WHERE again UNION SELECT doc_id, line FROM pairs WHERE again
  UNION SELECT doc_id, line2 FROM pairs WHERE again),
edges AS (SELECT doc_id, line, lag(line) OVER (PARTITION BY doc_id ORDER BY line) AS q FROM gone),
counted AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (q IS NULL OR q < line - 1) AS n_runs FROM edges GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY line) AS left_ FROM raw ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_runs, 0) AS n_runs, sha256(coalesce(left_, '')) AS kept_sha256
FROM split LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_MIXING = rf"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
  md5(CAST(doc_id AS VARCHAR)) AS o FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][r % 3 + 1] AS DOUBLE) AS w, CAST(source_size * 3 AS DOUBLE) AS cap, cap / w AS ratio,
  CAST([0.5, 1.0, 1.5][r % 3 + 1] AS DOUBLE) AS a, CAST([1.5, 1.0, 0.5][r % 3 + 1] AS DOUBLE) AS b FROM sources),
levels AS (SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER f, 0))
  / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM weighed WINDOW f AS (ORDER BY ratio, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, a, b, least(cap, w * (SELECT arg_min(level, row(ratio, r)) FROM levels WHERE level <= ratio))
  AS target FROM levels),
placed AS (SELECT *, CAST(round(target) AS BIGINT) AS demand, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY o, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT doc_id, source, size, source_size, target, a, b, demand, before,
  CASE WHEN source_size > 0 THEN demand // source_size * size
    + greatest(0, least(size, demand % source_size - before)) ELSE 0 END AS taken FROM placed)
SELECT doc_id, source, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN round(2 * (CAST(before AS DOUBLE) / demand * (a + b) / 2)
    / (a + sqrt(a * a + 2 * (b - a) * (CAST(before AS DOUBLE) / demand * (a + b) / 2))), 9) END AS position
FROM taken"""

_VECTORS = """
WITH RECURSIVE unit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (SELECT vec_id AS a, vec_id AS b FROM unit UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT reach.a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(b) AS component_id, reach.a = min(b) AS kept
FROM reach LEFT JOIN counted ON reach.a = counted.a GROUP BY reach.a"""

_SPELLING = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b)
    AS steps FROM (SELECT unnest(range(256)) AS b)),
runs AS (SELECT doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(
  flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x: CASE WHEN unicode(x) < 128
    THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)),
  lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295)) AS h FROM counted, crc),
said AS (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS a, c.n AS na, w.word AS b, w.n AS nb FROM cuts c JOIN words w ON w.word = c.cut),
near AS (
  SELECT a.word AS a, b.word AS b, b.n AS nb FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a, b, nb FROM shorter UNION ALL SELECT b, a, na FROM shorter),
best AS (SELECT a, count(*) AS n_near, arg_min(b, row(-nb, b)) AS b, max(nb) AS nb FROM near GROUP BY a),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN nb >= 2 * n THEN b END AS form,
  CASE WHEN nb >= 2 * n THEN nb END AS form_n FROM words LEFT JOIN best ON word = a),
walk AS (SELECT word, word AS node, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN formed f ON f.word = walk.node WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(node, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

_COPIES = """
WITH said AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM said GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM said JOIN groups USING (t)"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
said AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM said GROUP BY lang),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
    FROM said, range(1, 4) AS r(k) WHERE len(ws) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 10),
longer AS (
  SELECT lang, phrase, max(f) AS around FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')])
      AS phrase FROM f WHERE k = 3) GROUP BY lang, phrase),
cand AS (
  SELECT f.lang, f.phrase, f.k, f.f AS a, string_split(f.phrase, ' ') AS ws FROM f LEFT JOIN longer USING (lang, phrase)
  WHERE f.k = 3 OR f.k = 2 AND NOT coalesce(100 * around >= 50 * f.f, false)),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(ws[1:c], ' ') AS x, array_to_string(ws[c + 1:], ' ') AS y
  FROM cand, range(1, 3) AS r(c) WHERE c < k),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, fl.f AS l, fr.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
  FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = x JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {
    "op2_secrets": _SECRETS,
    "op3_suffixes": _STRINGS,
    "op5_minhash": _NEAR,
    "op7_passages": _PASSAGES,
    "op8_lines": _LINES,
    "op9_embeddings": _VECTORS,
    "op10_mixing": _MIXING,
    "op11_spelling": _SPELLING,
    "op12_copies": _COPIES,
    "op13_phrases": _PHRASES,
}
