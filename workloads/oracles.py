"""SQL the queries are checked against. It derives the same results from the given tables by rule, without JSON,
HTML or log text, so that an error in a job cannot hide in its check."""

from __future__ import annotations

_MD5_KEY = "concat('uuid:', md5(CAST({0} AS VARCHAR)))"

# One row per order: what its landed responses amount to, by the rules of the derived inputs.
_FACTS = """
ranked AS (
  SELECT *, row(l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) AS ord,
    (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice,
      l_shipdate) - 1) // 1000 * 1000000000000 AS block
  FROM lineitem),
landed_orders AS (
  SELECT orders.* REPLACE (o_orderkey + coalesce(block, 0) AS o_orderkey), o_orderkey AS base
  FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, block FROM ranked) ON o_orderkey = l_orderkey),
lines AS (
  SELECT l_orderkey + block AS k, l_linenumber AS num,
    concat('uuid:', md5(concat_ws('-', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
      CAST(l_linenumber AS VARCHAR)))) AS page,
    concat('uuid:', md5(CAST(l_partkey % 50 AS VARCHAR))) AS dom_page,
    ord
  FROM ranked),
rest_rows AS (
  SELECT k, CASE WHEN k % 41 = 0 THEN NULL ELSE num END AS page_number, arg_max(page, ord) AS page_id
  FROM lines GROUP BY ALL),
dom_first AS (SELECT k, dom_page, min(ord) AS ord FROM lines WHERE k % 3 <> 0 GROUP BY ALL),
dom_rows AS (
  SELECT k, dom_page AS page_id, row_number() OVER (PARTITION BY k ORDER BY ord) AS page_index FROM dom_first),
counts AS (SELECT k, count(*) AS rest_count FROM rest_rows GROUP BY ALL),
dom_counts AS (SELECT k, count(*) AS dom_count FROM dom_rows GROUP BY ALL),
facts AS (
  SELECT o_orderkey AS k, concat('uuid:', md5(CAST(o_orderkey AS VARCHAR))) AS document_id,
    o_custkey % 3 AS lib, c_name, o_orderpriority AS priority, o_orderkey % 7 AS kind,
    coalesce(rest_count, 0) AS rest_count,
    CASE WHEN o_orderkey % 17 = 0 THEN 'cert' WHEN o_orderkey % 11 IN (0, 1) THEN 'error'
      WHEN o_orderkey % 23 = 0 THEN 'cert' WHEN o_orderkey % 19 = 0 OR o_orderkey % 29 = 0 THEN 'error'
      ELSE 'ok' END AS rest_status,
    CASE WHEN o_orderkey % 29 = 0 OR o_orderkey % 37 = 0 THEN 'error' WHEN rest_count IS NULL THEN 'empty'
      WHEN o_orderkey % 31 = 0 THEN 'error' ELSE 'ok' END AS rest_kind,
    base % 5 <> 2 AS landed,
    o_orderkey % 43 <> 0 AND o_orderkey % 53 <> 0 AND o_orderkey % 47 <> 0 AS page_loaded,
    CASE WHEN o_orderkey % 43 = 0 THEN 'cert' WHEN o_orderkey % 53 = 0 THEN 'error'
      WHEN o_orderkey % 47 = 0 OR dom_count IS NULL THEN 'empty' ELSE 'ok' END AS page_kind,
    landed AND page_loaded AS loaded, CASE WHEN landed THEN page_kind ELSE 'empty' END AS dom_kind,
    CASE WHEN dom_kind = 'ok' THEN dom_count ELSE 0 END AS dom_count
  FROM landed_orders JOIN customer ON o_custkey = c_custkey LEFT JOIN counts ON o_orderkey = counts.k
    LEFT JOIN dom_counts ON o_orderkey = dom_counts.k),
pages_decided AS (
  SELECT *, CASE WHEN rest_status = 'ok' THEN rest_kind ELSE rest_status END AS rest,
    CASE WHEN rest = 'ok' THEN 'rest' WHEN rest IN ('error', 'cert') AND dom_kind = 'ok' THEN 'dom' END AS pages_source,
    CASE WHEN pages_source IS NOT NULL THEN NULL
      WHEN rest = 'cert' AND dom_kind IN ('empty', 'cert') THEN 'certificate' ELSE 'no_pages' END AS failure_class
  FROM facts),
texts AS (
  SELECT *, CASE WHEN kind IN (0, 1, 2, 4) THEN '' ELSE c_name END AS rest_title,
    CASE WHEN kind IN (3, 4) THEN '' ELSE priority END AS rest_subtitle,
    CASE WHEN loaded THEN concat(c_name, ' & more') ELSE '' END AS dom_title,
    CASE WHEN loaded THEN priority ELSE '' END AS dom_subtitle,
    CASE WHEN loaded AND k % 2 = 0 THEN concat('part ', CAST(k AS VARCHAR)) ELSE '' END AS dom_part_title,
    pages_source IS NOT DISTINCT FROM 'rest' AND kind <> 2 AS from_rest
  FROM pages_decided),
resolved AS (
  SELECT k, document_id, lib, pages_source, failure_class,
    CASE pages_source WHEN 'rest' THEN rest_count WHEN 'dom' THEN dom_count END AS page_count,
    CASE WHEN from_rest THEN rest_title ELSE dom_title END AS title,
    CASE WHEN from_rest THEN rest_subtitle ELSE dom_subtitle END AS subtitle,
    CASE WHEN from_rest THEN rest_title ELSE dom_part_title END AS part_title,
    CASE WHEN from_rest THEN rest_subtitle ELSE '' END AS part_subtitle,
    CASE WHEN from_rest THEN 'rest' ELSE 'dom' END AS field_source
  FROM texts),
page_rows AS (
  SELECT k, page_id, row_number() OVER (PARTITION BY k ORDER BY page_number) AS page_index
  FROM rest_rows JOIN resolved USING (k) WHERE pages_source = 'rest'
  UNION ALL
  SELECT k, page_id, page_index FROM dom_rows JOIN resolved USING (k) WHERE pages_source = 'dom')"""

_FIELDS = ("title", "subtitle", "part_title", "part_subtitle")


def _next_source(question: int) -> str:
    """The number of the source the search is with after a question (0: none), and what it said."""
    r, d, t = (f"{x}{question}" for x in "rdt")
    return f"""CASE WHEN a{question - 1} = 1 AND {r} IN ('ok', 'empty') THEN 1
      WHEN a{question - 1} = 2 AND {d} IN ('ok', 'empty') THEN 2 WHEN a{question - 1} = 3 AND {t} IN ('ok', 'empty') THEN 3
      WHEN {r} = 'ok' THEN 1 WHEN {d} = 'ok' THEN 2 WHEN {t} IN ('ok', 'empty') THEN 3 ELSE 0 END AS a{question},
    CASE a{question} WHEN 1 THEN rv{question} WHEN 2 THEN dv{question} WHEN 3 THEN tv{question} ELSE '' END AS v{question}"""


# A third source that shows its failures: kinds r, d, t and values of the three by question, pages first.
_THREE = """
said AS (
  SELECT *, rest AS r0, dom_kind AS d0, CASE k % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' WHEN 2 THEN 'cert' ELSE 'error' END AS t0,
    '' AS dom_part_subtitle, rest_title AS rv1, rest_subtitle AS rv2, rest_title AS rv3, rest_subtitle AS rv4,
    dom_title AS dv1, dom_subtitle AS dv2, dom_part_title AS dv3, dom_part_subtitle AS dv4,
    CASE WHEN k % 4 = 0 THEN concat('plain ', CAST(k AS VARCHAR)) ELSE '' END AS tv1,
    CASE WHEN k % 12 = 0 THEN priority ELSE '' END AS tv2, '' AS tv3, '' AS tv4
  FROM texts WHERE k < 1000000000000 AND k % 13 <> 0),
kinds AS (
  SELECT *, """ + ",\n    ".join(
    f"CASE WHEN rest_status <> 'ok' THEN rest_status {'WHEN kind = 2 THEN ' + chr(39) + 'error' + chr(39) if q % 2 else ''} "
    f"WHEN rv{q} = '' THEN 'empty' ELSE 'ok' END AS r{q}, CASE WHEN dv{q} = '' THEN 'empty' ELSE 'ok' END AS d{q}, "
    f"CASE WHEN t0 IN ('cert', 'error') THEN t0 WHEN tv{q} = '' THEN 'empty' ELSE 'ok' END AS t{q}" for q in (1, 2, 3, 4)) + """
  FROM said),
settled AS (
  SELECT document_id, k, CASE WHEN r0 IN ('ok', 'empty') THEN 1 WHEN d0 = 'ok' THEN 2 WHEN t0 IN ('ok', 'empty') THEN 3 ELSE 0 END AS a0,
    CASE WHEN r0 IN ('ok', 'empty') THEN CASE r0 WHEN 'ok' THEN 'rest' END WHEN d0 = 'ok' THEN 'dom' WHEN t0 = 'ok' THEN 'plain' END
      AS settled_on,
    CASE WHEN settled_on IS NULL THEN CASE WHEN r0 <> 'empty' AND 'cert' IN (r0, d0, t0) AND 'error' NOT IN (r0, d0, t0)
      THEN 'certificate' ELSE 'no_pages' END END AS failed,
    CASE settled_on WHEN 'rest' THEN rest_count WHEN 'dom' THEN dom_count WHEN 'plain' THEN 2 END AS counted,
    """ + ",\n    ".join(map(_next_source, (1, 2, 3, 4))) + """
  FROM kinds)"""

# URLs, with or without the copies, and what became of them.
_URLS = """
base_urls AS (
  SELECT o_orderkey AS pos, o_orderkey AS k, o_custkey % 3 AS lib, concat('https://lib',
    CAST(o_custkey % 3 AS VARCHAR), '.example.org/view/',
    CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE concat('uuid:', md5(CAST(o_orderkey AS VARCHAR))) END,
    CASE WHEN o_orderkey % 4 = 0 THEN concat('?page=uuid:', md5(CAST(o_custkey AS VARCHAR))) ELSE '' END) AS url
  FROM orders),
urls AS (
  SELECT * FROM base_urls UNION ALL
  SELECT pos + 1000000000, k, lib, url FROM base_urls WHERE pos % 50 = 0)"""

_LABELLED = """
labelled AS (
  SELECT pos, url, urls.k, CASE WHEN urls.lib < 2 THEN concat('lib', CAST(urls.lib AS VARCHAR)) END AS library_name,
    CASE WHEN urls.k % 13 <> 0 THEN document_id END AS document_id, pages_source, page_count, title, subtitle,
    part_title, part_subtitle,
    CASE WHEN urls.lib = 2 THEN 'unsupported_library' WHEN urls.k % 13 = 0 THEN 'no_identifier'
      ELSE failure_class END AS reason
  FROM urls JOIN resolved USING (k)),
documents_in AS (
  SELECT *, concat('output/', library_name, '/', replace(document_id, ':', '_'),
    CASE WHEN title <> '' THEN concat('_', title) ELSE '' END) AS output_dir
  FROM labelled WHERE reason IS NULL),
claims AS (
  SELECT output_dir, min(pos) AS pos FROM documents_in GROUP BY ALL),
granted AS (
  SELECT claims.pos FROM claims WHERE output_dir NOT IN (
    SELECT concat('output/lib0/uuid_', md5(CAST(o_orderkey AS VARCHAR))) FROM orders WHERE o_orderkey % 97 = 0)),
documents_out AS (
  SELECT documents_in.*, granted.pos IS NOT NULL AS dir_granted,
    CASE library_name WHEN 'lib0' THEN '--accept-invalid-certs' ELSE '' END AS args,
    library_name = 'lib0' AS allow_insecure,
    CASE library_name WHEN 'lib0' THEN 'images' ELSE 'scans' END AS subfolder
  FROM documents_in LEFT JOIN granted USING (pos))"""

_PAGE_COLUMNS = """
  concat(url, '?page=', page_id) AS page_url,
  concat('https://img', substr(library_name, 4), '.example.org/search/zoomify/', page_id, '/ImageProperties.xml')
    AS download_url,
  substr(concat(printf('page_%03d_', page_index), page_id), 1, 64) AS file_name"""

_ATTEMPTS = """
attempts AS (
  SELECT user_id AS doc_key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page_index, event_id,
    CASE WHEN event_id % 97 = 0 THEN 'tool_missing'
      WHEN event_type = 'error' AND event_id % 40 = 0 THEN 'exception'
      WHEN event_type = 'error' AND event_id % 5 = 1 THEN 'timeout'
      WHEN event_type = 'error' AND event_id % 6 <> 0 AND event_id % 3 = 0 AND event_id % 5 <> 0 THEN 'certificate'
      WHEN event_type = 'error' OR (event_type = 'purchase' AND event_id % 9 = 0) THEN 'error'
      ELSE 'ok' END AS reason,
    CASE WHEN reason IN ('ok', 'exception') THEN reason ELSE 'failed' END AS outcome
  FROM events),
stops AS (SELECT doc_key, min(page_index) AS stop FROM attempts WHERE outcome = 'exception' GROUP BY ALL),
outcomes AS (
  SELECT doc_key, count(*) AS pages,
    count(*) FILTER (outcome = 'ok' AND (stop IS NULL OR page_index < stop)) AS succeeded,
    count(*) FILTER (outcome <> 'ok' AND (stop IS NULL OR page_index <= stop)) AS failed,
    count(*) FILTER (page_index > stop) AS unattempted
  FROM attempts LEFT JOIN stops USING (doc_key) GROUP BY ALL)"""

_RUN = """
run AS (
  SELECT pos AS doc_key, page_index, pos * 31 + page_index AS n,
    CASE WHEN n % 397 = 0 THEN 'failed' WHEN n % 111 = 0 THEN 'exception' WHEN n % 53 = 0 OR n % 29 = 0 THEN 'failed'
      ELSE 'ok' END AS outcome
  FROM documents_out JOIN page_rows USING (k) WHERE dir_granted AND (pos * 31 + page_index) % 301 <> 0),
run_stops AS (SELECT doc_key, min(page_index) AS stop FROM run WHERE outcome = 'exception' GROUP BY ALL),
run_outcomes AS (
  SELECT doc_key, count(*) FILTER (outcome = 'ok' AND (stop IS NULL OR page_index < stop)) AS succeeded,
    count(*) FILTER (outcome <> 'ok' AND (stop IS NULL OR page_index <= stop)) AS failed
  FROM run LEFT JOIN run_stops USING (doc_key) GROUP BY ALL)"""

_FAILED = """
library_order AS (SELECT concat('lib', CAST(lib AS VARCHAR)) AS library_name, min(pos) AS library_first
  FROM urls WHERE lib < 2 GROUP BY ALL),
counted AS (
  SELECT d.*, coalesce(o.succeeded, 0) AS succeeded, coalesce(o.failed, 0) AS failed,
    d.page_count - coalesce(o.succeeded, 0) - coalesce(o.failed, 0) AS unattempted
  FROM documents_out d LEFT JOIN run_outcomes o ON o.doc_key = d.pos),
failed_documents AS (
  SELECT CASE WHEN reason = 'unsupported_library' THEN 0 ELSE 1 END AS phase, CAST(-1 AS BIGINT) AS library_first,
    pos, url, reason, CAST(NULL AS BIGINT) AS succeeded, CAST(NULL AS BIGINT) AS failed,
    CAST(NULL AS BIGINT) AS unattempted
  FROM labelled WHERE reason IS NOT NULL
  UNION ALL
  SELECT 2, library_first, pos, url, CASE WHEN dir_granted THEN 'pages' ELSE 'dir_exists' END,
    CASE WHEN dir_granted THEN succeeded END, CASE WHEN dir_granted THEN counted.failed END,
    CASE WHEN dir_granted THEN unattempted END
  FROM counted JOIN library_order USING (library_name)
  WHERE NOT dir_granted OR counted.failed > 0 OR unattempted > 0)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


_LINES = """
url_lines AS (
  SELECT page_id AS pos, CASE page_id % 8 WHEN 3 THEN concat('# ', url) WHEN 5 THEN '   '
    WHEN 6 THEN concat('  ', url, '  ') ELSE url END AS line
  FROM pages),
manifest AS (
  SELECT pos, trim(line) AS url FROM url_lines WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%')"""

_REGISTRY = """
registry(library_pos, library_name, prefix_pos, base_url) AS (VALUES (0, 'Lib_WWW', 0, 'https://www.'),
  (0, 'Lib_WWW', 1, 'http://www.'), (1, 'Lib_BLOG', 0, 'https://blog.'), (2, 'Lib_HTTPS', 0, 'https://'),
  (3, 'Lib_BLOGHTTP', 0, 'http://blog.')),
owners AS (
  SELECT pos, arg_min(row(library_pos, library_name, base_url), row(library_pos, prefix_pos)) AS owner
  FROM manifest JOIN registry ON starts_with(url, base_url) GROUP BY ALL)"""

_CLEAN_HTML = r"""
cleaned AS (
  SELECT page_id AS document_id, regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS html
  FROM pages)"""

_OPTION_COLUMNS = """
  {args} AS args, {insecure} AS allow_insecure,
  CASE lib WHEN 0 THEN 'images' WHEN 1 THEN 'scans' ELSE 'images' END AS subfolder, {insecure} AS insecure,
  {contradiction} AS contradiction"""

ORACLES: dict[str, str] = {
    "url_manifest": _with(_LINES) + "SELECT pos, url FROM manifest",
    "url_manifest_files": """
      SELECT place AS pos, trim(line) AS url FROM (
        SELECT row_number() OVER (ORDER BY (page_id + 1) % 3, page_id) - 1 AS place, CASE page_id % 8 WHEN 3 THEN '# ' || url
          WHEN 5 THEN '   ' WHEN 6 THEN '  ' || url || '  ' ELSE url END AS line FROM pages)
      WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%'""",
    "assign_library": _with(_LINES, _REGISTRY)
    + "SELECT pos, url, owner[1] AS library_pos, owner[2] AS library_name, owner[3] AS base_url "
    "FROM manifest LEFT JOIN owners USING (pos)",
    "assign_library_many": _with(_URLS) + """
      SELECT pos, CAST(CASE WHEN n IS NULL THEN NULL WHEN n % 97 < 48 THEN n % 97 ELSE 48 END AS INTEGER) AS library_pos,
        CASE WHEN n IS NULL THEN NULL WHEN n % 97 < 48 THEN concat('shelf', CAST(n % 97 AS VARCHAR)) ELSE 'rest' END AS library_name,
        CASE WHEN n IS NULL THEN NULL WHEN n % 97 < 48 THEN substr(url, 1, 38) ELSE substr(url, 1, 36) END AS base_url
      FROM (SELECT pos, url, CASE WHEN lib < 2 AND url LIKE '%/view/uuid:%'
        THEN CAST(concat('0x', substr(url, 36, 3)) AS BIGINT) END AS n FROM base_urls)""",
    "document_ids": _with(_URLS)
    + r"""SELECT pos, url, id AS document_id,
      concat('https://api.example.org/', 'doc?q=PID:', replace(id, ':', '\:'), '&rows=10000') AS document_request_url,
      concat('https://api.example.org/', 'pages?q="', id, '"&rows=4000') AS pages_request_url
    FROM (SELECT pos, url, concat('uuid:', md5(CAST(k AS VARCHAR))) AS id FROM base_urls WHERE k % 13 <> 0)
    UNION ALL SELECT pos, url, NULL, NULL, NULL FROM base_urls WHERE k % 13 = 0""",
    "admit_responses": _with(_FACTS) + "SELECT document_id, rest_status FROM facts WHERE k < 1000000000000 "
    "AND k % 13 <> 0",
    "rest_metadata": """
    SELECT document_id, CASE WHEN k % 17 = 0 THEN 'cert' WHEN k % 11 IN (0, 1) THEN 'error' ELSE 'ok' END AS doc_state,
      title_kind, title, subtitle_kind, subtitle, title_kind AS part_title_kind, title AS part_title,
      subtitle_kind AS part_subtitle_kind, subtitle AS part_subtitle
    FROM (SELECT o_orderkey AS k, concat('uuid:', md5(CAST(o_orderkey AS VARCHAR))) AS document_id,
      CASE o_orderkey % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'missing' WHEN 4 THEN 'missing' WHEN 2 THEN 'invalid'
        ELSE 'string' END AS title_kind,
      CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 4 THEN '' WHEN 2 THEN '42' ELSE c_name END AS title,
      CASE o_orderkey % 7 WHEN 3 THEN 'missing' WHEN 4 THEN 'missing' ELSE 'string' END AS subtitle_kind,
      CASE o_orderkey % 7 WHEN 3 THEN '' WHEN 4 THEN '' ELSE o_orderpriority END AS subtitle
      FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "rest_page_kinds": _with(_FACTS) + "SELECT document_id, rest_kind AS rest_pages_kind, "
    "CASE WHEN rest_kind = 'ok' THEN rest_count END AS pages, rest_kind <> 'empty' AND k % 37 <> 0 AND k % 29 <> 0 "
    "AND k IN (SELECT k FROM lines GROUP BY k HAVING count(*) = 4) AS maybe_truncated FROM facts",
    "rest_pages": _with(_FACTS) + "SELECT document_id, page_number, row_number() OVER (PARTITION BY k "
    "ORDER BY page_number) AS page_index, page_id FROM rest_rows JOIN facts USING (k) WHERE rest_kind = 'ok'",
    "rest_pages_large_numbers": _with(_FACTS) + "SELECT document_id, page_number + 9007199254740989 AS page_number, "
    "row_number() OVER (PARTITION BY k ORDER BY page_number) AS page_index, page_id FROM rest_rows JOIN facts USING (k) "
    "WHERE rest_kind = 'ok'",
    "dom_pages": _with(_CLEAN_HTML)
    + r""", tags AS (
      SELECT document_id, unnest(found) AS tag, generate_subscripts(found, 1) AS place
      FROM (SELECT document_id, regexp_extract_all(html,
        '(?i)<a\b((?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1) AS found FROM cleaned)),
    targets AS (
      SELECT document_id, regexp_extract(regexp_extract(tag, '(?i)(?:^|\s)href\s*=\s*"([^"]*)"', 1), '^/(.+)$', 1)
        AS page_id, place FROM tags)
    SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY min(place)) AS page_index, page_id
    FROM targets WHERE page_id <> '' GROUP BY document_id, page_id""",
    "dom_page_elements": _with(_FACTS) + "SELECT document_id, page_index, page_id FROM dom_rows "
    "JOIN facts USING (k) WHERE page_loaded",
    "dom_kinds": _with(_FACTS) + "SELECT document_id, page_kind AS dom_kind FROM facts",
    "dom_text": _with(_CLEAN_HTML)
    + r"""SELECT document_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(regexp_extract(html, '(?is)<article\b[^>]*>.*?<h1\b[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
      '&quot(;|\b)', '"', 'g'), '&copy(;|\b)', '©', 'g'), '&middot(;|\b)', '·', 'g'), '&lt(;|\b)', '<', 'g'),
      '&amp(;|\b)', '&', 'g')) AS headline
    FROM cleaned""",
    "dom_text_deep": "SELECT page_id AS document_id, concat('deep ', CAST(page_id AS VARCHAR)) AS headline FROM pages",
    "dom_text_wide": "SELECT page_id AS document_id, coalesce(array_to_string(list_transform(list_filter(range(0, page_id % 3000 + 1), "
    "lambda i: i % 7 = 0), lambda i: CAST(i AS VARCHAR)), ' '), '') AS headline, coalesce(array_to_string(list_transform(list_filter("
    "range(0, page_id % 3000 + 1), lambda i: i % 7 = 0), lambda i: CAST(i AS VARCHAR)), ' '), '') AS bare FROM pages",
    "dom_metadata": _with(_FACTS) + "SELECT document_id, CASE WHEN page_loaded THEN concat(c_name, ' & more') ELSE '' END "
    "AS dom_title, CASE WHEN page_loaded THEN priority ELSE '' END AS dom_subtitle, CASE WHEN page_loaded AND k % 2 = 0 "
    "THEN concat('part ', CAST(k AS VARCHAR)) ELSE '' END AS dom_part_title, '' AS dom_part_subtitle FROM facts",
    "resolve_pages": _with(_FACTS) + "SELECT document_id, pages_source, failure_class, page_count FROM resolved "
    "WHERE k < 1000000000000 AND k % 13 <> 0",
    "resolve_three_sources": _with(_FACTS) + """SELECT document_id, pages_source, failure_class FROM (SELECT document_id,
      CASE WHEN rest IN ('ok', 'empty') THEN nullif(rest, 'empty')
        WHEN dom = 'ok' THEN 'dom' WHEN third = 'ok' THEN 'third' END AS found,
      CASE found WHEN 'ok' THEN 'rest' ELSE found END AS pages_source,
      CASE WHEN found IS NOT NULL THEN NULL WHEN rest = 'empty' THEN 'no_pages'
        WHEN 'error' IN (rest, dom, third) THEN 'no_pages' ELSE 'certificate' END AS failure_class
    FROM (SELECT *, CASE WHEN landed THEN page_kind ELSE 'error' END AS dom,
      CASE k % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' WHEN 2 THEN 'cert' ELSE 'error' END AS third FROM pages_decided)
    WHERE k < 1000000000000 AND k % 13 <> 0)""",
    "resolve_metadata_three_sources": _with(_FACTS, _THREE) + """
      SELECT document_id, settled_on AS pages_source, failed AS failure_class, counted AS page_count, """ + ", ".join(
        f"CASE WHEN settled_on IS NOT NULL THEN v{i} END AS {name}, CASE WHEN settled_on IS NOT NULL AND a{i} > 0 "
        f"THEN ['rest', 'dom', 'plain'][a{i}] END AS {name}_source" for i, name in enumerate(_FIELDS, 1))
    + " FROM settled",
    "three_source_page_rows": _with(_FACTS, _THREE) + """
      SELECT document_id, n AS page_index, concat('uuid:', md5(concat(CAST(k AS VARCHAR), '-', CAST(n AS VARCHAR)))) AS page_id
      FROM settled, (VALUES (1), (2)) AS pages(n) WHERE settled_on = 'plain'""",
    "resolve_pages_explicit": _with(_FACTS) + "SELECT document_id, 'explicit' AS pages_source, "
    "CAST(NULL AS VARCHAR) AS failure_class, CAST(3 AS BIGINT) AS page_count, dom_title AS title FROM texts "
    "WHERE k < 1000000000000 AND k % 13 <> 0",
    "resolved_page_rows": _with(_FACTS) + "SELECT document_id, page_index, page_id FROM page_rows "
    "JOIN resolved USING (k) WHERE k < 1000000000000 AND k % 13 <> 0",
    "resolve_metadata": _with(_FACTS) + "SELECT document_id, title, subtitle, part_title, part_subtitle, "
    "field_source AS title_source, field_source AS part_subtitle_source FROM resolved WHERE k < 1000000000000 AND k % 13 <> 0 "
    "AND pages_source IS NOT NULL",
    "assemble_documents": _with(_FACTS, _URLS, _LABELLED) + "SELECT pos AS doc_key, url AS source_url, library_name, "
    "document_id, pages_source, page_count, title, subtitle, part_title, part_subtitle FROM documents_in",
    "preprocess_failures": _with(_FACTS, _URLS, _LABELLED)
    + "SELECT pos, url, library_name, reason FROM labelled WHERE reason IS NOT NULL",
    "page_table": _with(_FACTS, _URLS, _LABELLED) + "SELECT pos AS doc_key, document_id, page_index, page_id,"
    + _PAGE_COLUMNS + " FROM documents_in JOIN page_rows USING (k)",
    "landed_page_table": _with(_FACTS) + "SELECT k AS doc_key, document_id, page_index, page_id, "
    "substr(concat(printf('page_%03d_', page_index), page_id), 1, 64) AS file_name FROM (SELECT k, document_id, "
    "page_id, row_number() OVER (PARTITION BY k ORDER BY page_number) AS page_index FROM rest_rows "
    "JOIN facts USING (k) WHERE rest_kind = 'ok')",
    "output_dirs": _with(_FACTS, _URLS, _LABELLED)
    + "SELECT pos AS doc_key, document_id, output_dir FROM documents_in",
    "output_dirs_part_names": r"""SELECT p_partkey AS doc_key, concat('output/Lib_/part_', CAST(p_partkey AS VARCHAR),
      '_', rtrim(regexp_replace(concat(p_name, ' <', CAST(p_partkey % 7 AS VARCHAR), '>/ "', p_name, '": ?*|'),
      '[\\/:*?"<>|]', '', 'g'))) AS output_dir FROM part""",
    "dir_conflicts": _with(_FACTS, _URLS, _LABELLED)
    + "SELECT pos AS doc_key, output_dir, dir_granted FROM documents_out",
    "effective_options": _with(_URLS) + "SELECT pos,"
    + _OPTION_COLUMNS.format(
        args="CASE lib WHEN 0 THEN '--accept-invalid-certs' WHEN 1 THEN '' ELSE '--largest' END",
        insecure="lib = 0",
        contradiction="false",
    )
    + " FROM base_urls",
    "effective_options_run": _with(_URLS) + "SELECT pos,"
    + _OPTION_COLUMNS.format(args="'--max-width 4000'", insecure="false", contradiction="false")
    + " FROM base_urls",
    "effective_options_clashing": _with(_URLS) + """SELECT pos, CASE lib WHEN 1 THEN '--accept-invalid-certs --largest'
      ELSE '--accept-invalid-certs' END AS args, lib = 0 AS allow_insecure, CASE lib WHEN 2 THEN 'scans' END AS subfolder,
      lib = 0 AS insecure, lib <> 0 AS contradiction FROM base_urls""",
    "option_warnings": _with(_URLS) + """SELECT scope, insecure, contradiction, count(*) AS documents FROM base_urls
      JOIN (VALUES (NULL, false, true), ('lib0', true, false), ('lib1', false, true)) w(scope, insecure, contradiction)
      ON scope IS NULL OR scope = concat('lib', CAST(lib AS VARCHAR)) GROUP BY ALL""",
    "work_orders": _with(_FACTS, _URLS, _LABELLED) + "SELECT pos AS doc_key, page_index, page_url, concat_ws(' ', "
    "'dezoomify-rs', nullif(args, ''), download_url, concat(output_dir, '/', subfolder, '/', file_name)) AS command "
    "FROM (SELECT documents_out.*, page_index, " + _PAGE_COLUMNS
    + " FROM documents_out JOIN page_rows USING (k) WHERE dir_granted)",
    "attempt_outcomes": _with(_ATTEMPTS) + "SELECT doc_key, page_index, event_id, outcome, reason FROM attempts",
    "cert_logs": "SELECT event_id, event_type = 'error' AND event_id % 3 = 0 AND event_id % 5 <> 0 AS certificate_only "
    "FROM events",
    "cert_causes": _with(
        """
    edges AS (
      SELECT event_id AS a, event_id + 1 AS b FROM events WHERE event_id % 8 <> 7
      UNION ALL SELECT event_id, event_id - 7 FROM events WHERE event_id % 16 = 15),
    walk AS (
      SELECT event_id AS root, event_id AS node FROM events WHERE event_id % 8 = 0
      UNION SELECT root, b FROM walk JOIN edges ON node = a)""",
        recursive=True,
    )
    + "SELECT root AS error_id, bool_or(event_id IS NOT NULL AND node % 23 = 0) AS is_certificate FROM walk "
    "LEFT JOIN events ON node = event_id GROUP BY root",
    "cert_causes_long": _with(
        """
    edges AS (
      SELECT event_id AS a, event_id + 1 AS b FROM events WHERE event_id % 512 <> 511
      UNION ALL SELECT event_id, event_id - 511 FROM events WHERE event_id % 1024 = 1023
      UNION ALL SELECT event_id, event_id + 700 FROM events WHERE event_id % 100 = 50),
    bad AS (
      SELECT event_id AS node FROM events WHERE event_id % 1901 = 7
      UNION SELECT a FROM bad JOIN edges ON node = b)""",
        recursive=True,
    )
    + "SELECT event_id AS error_id, event_id IN (SELECT node FROM bad) AS is_certificate FROM events WHERE event_id % 64 = 3",
    "page_lists": _with(_FACTS, _URLS, _LABELLED) + "SELECT pos AS doc_key, string_agg(page_id, '|' "
    "ORDER BY page_index) AS page_ids, count(*) AS page_count FROM documents_in JOIN page_rows USING (k) GROUP BY pos",
    "document_manifest": _with(_FACTS, _URLS, _LABELLED)
    + """SELECT library_name, pos AS doc_key, url AS source_url, document_id AS document_uuid, title, subtitle,
      part_title, part_subtitle, page_count, args, CAST(allow_insecure AS VARCHAR) AS allow_insecure, subfolder, pages,
      concat('Source URL: ', url, chr(10), 'Document_uuid: ', document_id, chr(10), 'Title: ', title, chr(10),
        'Subtitle: ', subtitle, chr(10), 'Part title: ', part_title, chr(10), 'Part subtitle: ', part_subtitle,
        chr(10), 'pages:', chr(10), page_lines, 'Page count: ', CAST(page_count AS VARCHAR), chr(10),
        'Dezoomify-rs path: dezoomify-rs', chr(10), 'Dezoomify-rs args: ', args, chr(10), 'Allow insecure: ',
        CAST(allow_insecure AS VARCHAR), chr(10), 'Images subfolder: ', subfolder, chr(10),
        'Date: 2024-01-02 03:04:05', chr(10)) AS text
    FROM documents_out JOIN (SELECT k, string_agg(page_id, '|' ORDER BY page_index) AS pages,
      string_agg(concat('    ', page_id, chr(10)), '' ORDER BY page_index) AS page_lines FROM page_rows GROUP BY k)
      USING (k)
    WHERE dir_granted""",
    "document_outcomes": _with(_ATTEMPTS) + "SELECT doc_key, succeeded, failed, unattempted FROM outcomes",
    "failed_documents": _with(_FACTS, _URLS, _LABELLED, _RUN, _FAILED) + "SELECT * FROM failed_documents",
    "run_summary": _with(_FACTS, _URLS, _LABELLED, _RUN, _FAILED)
    + "SELECT (SELECT count(*) FROM urls) AS input_count, (SELECT count(*) FROM failed_documents) AS failed_count, "
    "CASE WHEN (SELECT count(*) FROM failed_documents) > 0 THEN 1 ELSE 0 END AS exit_code",
    "library_documents": _with(_FACTS, _URLS, _LABELLED, _RUN, _FAILED)
    + "SELECT library_name, library_first, (SELECT count(*) FROM documents_in d WHERE d.library_name = "
    "library_order.library_name) AS documents FROM library_order",
}

ORACLES["manifest_written"] = (
    f"SELECT library_name, doc_key, document_uuid, title, page_count, pages FROM ({ORACLES['document_manifest']})")
# Retries, buckets and scripts change the input, not what comes out.
ORACLES["admit_responses_bucketed"] = ORACLES["admit_responses"]
ORACLES["admit_responses_retries"] = ORACLES["admit_responses"]
ORACLES["dom_pages_scripts"] = ORACLES["dom_pages"]
