"""Expected results of the catalog in SQL.

Where a query builds markup from plain values, the SQL states the Markdown those values
must give and shares nothing with the converters. Raw pages are checked by the passes
spelled for another regular expression engine.
"""

from __future__ import annotations

from docmill.functions.strings import JS_SPACE
from docmill.operators.engines import NOISE
from docmill.operators.results import REMEDY
from docmill.operators.routing import NATIVE, PLAIN, UNSUPPORTED
from docmill.options import ENGINES
from docmill.plans.catalog import CONTENT_TYPES, MAX_BYTES, MAX_CHARS, NAMES, PIECE_CHARS

ORACLES: dict[str, str] = {}

NL = "chr(10)"
PARA = "chr(10) || chr(10)"
SPACE = "'" + JS_SPACE + "'"


def trim(x: str) -> str:
    return f"trim({x}, {SPACE})"


def rtrim(x: str) -> str:
    return f"rtrim({x}, {SPACE})"


def sub(x: str, pattern: str, new: str = "''") -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_replace({x}, '{quoted}', {new}, 'g')"


def norm(x: str) -> str:
    t = sub(x, r"\r\n?", NL)
    t = sub(t, r"(?m)[ \t]+$")
    return trim(sub(t, r"\n{3,}", PARA))


def squeeze(x: str) -> str:
    return trim(sub(x, r"[\t\n\v\f\r ]+", "' '"))


def cell(x: str) -> str:
    return trim(sub(f"replace({x}, '|', '\\|')", r"\r?\n", "' '"))


def pick(values, number: str) -> str:
    listed = ", ".join("'" + v + "'" for v in values)
    return f"([{listed}])[CAST({number} % {len(values)} AS BIGINT) + 1]"


def escaped(x: str) -> str:
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = f"replace({x}, '{char}', '{reference}')"
    return x


LINES = f"string_split(text, {NL})"
# One row per line of every document, numbered from 0.
BY_LINE = f"""
  lines AS (
    SELECT doc_id, text, unnest(list_zip({LINES}, range(len({LINES})))) AS z FROM documents
  ),
  l AS (SELECT doc_id, text, z[1] AS line, z[2] AS i FROM lines)"""


def each_line(expression: str) -> str:
    """List over the lines of a document; ``line`` and ``i`` (from 0) may be used."""
    return f"list_transform({LINES}, lambda line, j: (list_transform([j - 1], lambda i: {expression}))[1])"


def text_list(expression: str, between: str = NL) -> str:
    return f"array_to_string({each_line(expression)}, {between})"


def per_document(name: str, expression: str) -> None:
    ORACLES[name] = f"SELECT doc_id, {expression} AS result FROM documents"


def per_page(name: str, expression: str) -> None:
    ORACLES[name] = f"SELECT page_id, {expression} AS result FROM pages"


# Pages: the passes as a chain of common table expressions.


def entities(x: str) -> str:
    """References that occur in the pages; the ampersand comes last, as in a single pass."""
    for reference, char in (("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{reference}', {char})"
    return x


ANCHOR = r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>".replace('\\"', '"')


def links(x: str) -> str:
    return sub(x, ANCHOR, r"'[\2](\1)'")


def inline(x: str) -> str:
    return squeeze(entities(sub(links(x), "<[^>]+>")))


def each_match(x: str, pattern: str, expression: str) -> str:
    """Replace matches by an expression over ``m``, the captured text."""
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{pattern}'), "
        f"list_transform(regexp_extract_all({x}, '{pattern}', 1), lambda m: {expression})), "
        "lambda z: z[1] || coalesce(z[2], '')), '')"
    )


DROPPED = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in ("script", "style", "noscript", "svg", "head"))
BLOCK_NAMES = "p|div|section|article|header|footer|tr|figure|figcaption"


def drop_blocks(x: str) -> str:
    return sub(sub(x, r"(?s)<!--.*?-->"), DROPPED)


def breaks(x: str) -> str:
    return sub(sub(x, r"(?i)<br\s*/?>", NL), r"(?i)<hr\s*/?>", f"{PARA} || '---' || {PARA}")


def blocks(x: str) -> str:
    t = sub(x, rf"(?i)<(?:{BLOCK_NAMES})\b[^>]*>", PARA)
    return sub(t, rf"(?i)</(?:{BLOCK_NAMES})>", PARA)


HEADING = each_match("t", r"(?is)<h1\b[^>]*>(.*?)</h1>", f"{PARA} || '# ' || {inline('m')} || {PARA}")
ITEM = each_match("t", r"(?is)<li\b[^>]*>(.*?)</li>", f"{NL} || '- ' || {inline('m')}")
PAGE_MARKDOWN = f"""
  p1 AS (SELECT page_id, url, {breaks(drop_blocks('html'))} AS t FROM pages),
  p2 AS (SELECT page_id, url, {HEADING} AS t FROM p1),
  p3 AS (SELECT page_id, url, {ITEM} AS t FROM p2),
  p4 AS (SELECT page_id, url, {blocks(sub('t', '(?i)</(?:ul|ol|dl)>', PARA))} AS t FROM p3),
  page_md AS (SELECT page_id, url, {norm(entities(sub(links('t'), '<[^>]+>')))} AS markdown FROM p4)"""


# Scans, sources, sinks

ORACLES["scan_documents"] = f"""
SELECT page_id, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS length,
  CASE WHEN octet_length(encode(html)) + 1 > {MAX_BYTES} THEN 'too_large' ELSE 'ok' END AS status,
  CASE WHEN octet_length(encode(html)) + 1 <= {MAX_BYTES} THEN md5(html || {NL}) END AS digest
FROM pages"""

ORACLES["resolve_manifest"] = """
WITH wanted AS (
  SELECT doc_id, CASE WHEN doc_id % 12 = 0 THEN ' file:///corp%75s/d' || doc_id % 7 || '/' || doc_id || '.html '
    WHEN doc_id % 12 = 4 THEN '/corpus/x/y/../../d' || doc_id % 7 || '/' || doc_id || '.html'
    ELSE CASE doc_id % 4
    WHEN 0 THEN '/corpus//./d' || doc_id % 7 || '/' || doc_id || '.html'
    WHEN 1 THEN '/corpus/d' || doc_id % 7 || '/' || doc_id || '.html'
    WHEN 2 THEN '/corpus/d' || doc_id % 9 || '/'
    ELSE '/elsewhere/' || doc_id END END AS input
  FROM documents)
SELECT doc_id, input,
  CASE WHEN doc_id % 4 < 2 THEN CAST(octet_length(encode(html)) AS BIGINT) END AS length,
  CASE WHEN doc_id % 4 < 2 AND page_id IS NOT NULL THEN 'ok'
       WHEN doc_id % 4 = 2 AND doc_id % 9 < 7 THEN 'not_a_file' ELSE 'not_found' END AS status,
  CASE WHEN doc_id % 4 < 2 AND page_id IS NOT NULL THEN NULL
       WHEN doc_id % 4 = 2 AND doc_id % 9 < 7 THEN 'a folder was named: ' || input
       ELSE 'nothing is there: ' || input END AS error
FROM wanted LEFT JOIN pages ON page_id = doc_id"""

ORACLES["classify_input"] = f"""
WITH raw AS (
  SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'HTTPS' || substr(url, strpos(url, ':'))
    WHEN 2 THEN 'file:///data/a%20b+c/' || page_id || '.txt' WHEN 3 THEN '/data/' || page_id
    WHEN 4 THEN '' ELSE 'File://host/' || page_id END AS input
  FROM pages)
SELECT page_id, allow_urls, input, CASE WHEN page_id % 6 < 2 THEN 'url' ELSE 'file' END AS kind,
  CASE page_id % 6 WHEN 2 THEN '/data/a b+c/' || page_id || '.txt' WHEN 5 THEN NULL ELSE input END AS target,
  CASE WHEN page_id % 6 < 2 AND NOT allow_urls THEN 'url_disabled' WHEN page_id % 6 = 4 THEN 'empty_input'
    WHEN page_id % 6 = 5 THEN 'not_found' ELSE 'ok' END AS status,
  CASE WHEN page_id % 6 < 2 AND NOT allow_urls THEN 'URLs are switched off'
    WHEN page_id % 6 = 4 THEN 'no input was named'
    WHEN page_id % 6 = 5 THEN 'a file URL of another host: ' || input END AS error
FROM raw CROSS JOIN (VALUES (true), (false)) AS v(allow_urls)"""

URL_PATH = "string_split(regexp_split_to_array(url, '[?#]')[1], '/')"
RESPONSE_NAME = f"CASE WHEN len({URL_PATH}) > 3 AND {URL_PATH}[-1] <> '' THEN {URL_PATH}[-1] ELSE 'index.html' END"
ORACLES["scan_responses"] = f"""
WITH r AS (
  SELECT page_id, url, {RESPONSE_NAME} AS name, {pick(CONTENT_TYPES, 'page_id')} AS content_type, html,
    CAST(octet_length(encode(html)) AS BIGINT) AS length,
    CASE WHEN page_id % 10 = 3 THEN 'http_error' WHEN page_id % 10 = 4 THEN 'declared'
      WHEN octet_length(encode(html)) > {MAX_BYTES} THEN 'body' ELSE 'ok' END AS found
  FROM pages)
SELECT page_id, name, content_type, length,
  CASE WHEN found IN ('declared', 'body') THEN 'too_large' ELSE found END AS status,
  CASE found WHEN 'http_error' THEN 'fetch ' || url || ' failed with HTTP 404'
    WHEN 'declared' THEN url || ' declares {2 * MAX_BYTES} bytes, above the configured max_bytes of {MAX_BYTES}'
    WHEN 'body' THEN 'response body exceeded the configured max_bytes of {MAX_BYTES}' END AS error,
  CASE WHEN found = 'ok' THEN md5(html) END AS digest
FROM r"""

ORACLES["parse_delimited"] = f"""
WITH {BY_LINE}
SELECT doc_id, CAST(i AS BIGINT) AS row_no, CAST(CASE WHEN i % 3 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_cells,
  i || '¦' || line || CASE WHEN i % 3 = 0 THEN '¦extra' ELSE '' END AS cells
FROM l"""

ORACLES["scan_delimited"] = """
SELECT c_custkey, CAST(CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 4 END AS BIGINT) AS n_cells,
  c_custkey || '¦' || c_name || ', "' || c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || chr(10) || 'end' ELSE '' END || '"' ||
  CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN '¦¦' WHEN 2 THEN '¦zw¦' ELSE '¦¦x' || c_nationkey END AS cells
FROM customer"""

ORACLES["explode_archive"] = """
SELECT page_id AS doc_id, CAST(1 AS BIGINT) AS entry_idx, 'a/page ' || page_id || '.html' AS part, md5(html) AS digest,
  'ok' AS status FROM pages WHERE page_id % 7 <> 0
UNION ALL
SELECT page_id, CAST(2 AS BIGINT), 'url.txt', md5(url), 'ok' FROM pages WHERE page_id % 7 <> 0
UNION ALL
SELECT page_id, NULL, NULL, NULL, 'bad_container' FROM pages WHERE page_id % 7 = 0"""

ORACLES["write_markdown"] = f"""
SELECT doc_id, 'text' AS format, CAST(length({norm('text')}) AS BIGINT) AS chars, false AS truncated, true AS has_path,
  true AS body_left_out, true AS has_hint, md5({norm('text')}) AS digest
FROM documents"""

# Routing

EXT = pick(NAMES, "doc_id")
NAMED = f"""
  n AS (
    SELECT doc_id, text, CASE doc_id % 11 WHEN 0 THEN 'Makefile' || doc_id WHEN 1 THEN 'C:\\dir.d\\.' || {EXT}
      WHEN 2 THEN 'https://x.test/a.b/f' || doc_id || '.' || {EXT} || '?q=1.pdf#x.y'
      WHEN 3 THEN 'dir.x/a.' || doc_id || '.' ELSE 'd/f' || doc_id || '.' || upper({EXT}) END AS name,
      CASE WHEN doc_id % 11 IN (0, 1, 3) THEN '' ELSE {EXT} END AS extension
    FROM documents)"""


def values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join("'" + v + "'" for v in row) + ")" for row in rows)


FORMATS = f"""
  f(ext, format) AS ({values([*NATIVE.items(), *((p, 'text') for p in PLAIN), *((u, 'unsupported') for u in UNSUPPORTED)])}),
  u(ext, reason) AS ({values(UNSUPPORTED.items())})"""
ORACLES["extension_of"] = f"WITH {NAMED} SELECT doc_id, name, extension FROM n"
ORACLES["route_format"] = f"""
WITH {NAMED}, {FORMATS},
  r AS (
    SELECT doc_id, name, extension, coalesce(f.format, CASE WHEN extension = '' THEN 'unknown' ELSE 'text' END) AS format, reason
    FROM n LEFT JOIN f ON f.ext = extension LEFT JOIN u ON u.ext = extension),
  s AS (
    SELECT *, CASE WHEN format = 'unsupported' THEN 'unsupported' WHEN format = 'unknown' THEN 'no_extension'
      WHEN format = 'text' AND doc_id % 5 = 0 THEN 'binary' ELSE 'ok' END AS status FROM r)
SELECT doc_id, name, extension, format, CASE WHEN status <> 'ok' THEN 'refused'
    WHEN format IN ('docx', 'xlsx', 'pptx', 'epub') THEN 'container' ELSE 'inline' END AS family, status,
  CASE status WHEN 'unsupported' THEN '.' || extension || ': ' || reason
    WHEN 'no_extension' THEN 'the name has no extension to go by'
    WHEN 'binary' THEN '.' || extension || ' holds binary data' END AS error
FROM s"""
ORACLES["supports_format"] = f"""
WITH {NAMED}, {FORMATS}
SELECT doc_id, name, extension IN (SELECT ext FROM f WHERE format <> 'unsupported') AS supported FROM n"""
ORACLES["route_response"] = f"""
WITH r AS (SELECT page_id, {RESPONSE_NAME} AS name, {pick(CONTENT_TYPES, 'page_id')} AS content_type FROM pages),
  s AS (
    SELECT *, CASE page_id % {len(CONTENT_TYPES)} WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 2 THEN 'csv'
      ELSE CASE WHEN name LIKE '%.html' THEN 'html' WHEN strpos(name, '.') = 0 THEN 'unknown' ELSE 'text' END END AS format
    FROM r)
SELECT page_id, name, content_type, format, CASE WHEN format = 'unknown' THEN 'refused' ELSE 'inline' END AS family,
  CASE WHEN format = 'unknown' THEN 'no_extension' ELSE 'ok' END AS status
FROM s"""
ORACLES["is_binary"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN octet_length(encode(text)) < 8192
  WHEN 3 THEN true ELSE false END AS binary
FROM documents"""
ORACLES["short_name"] = f"""
WITH s AS (SELECT page_id, url, list_filter({URL_PATH}, lambda p: p <> '') AS segments FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/data/x y/' || page_id || '.txt '
    WHEN 1 THEN 'https://host' || page_id || '.test?q' WHEN 2 THEN 'dir/sub' || page_id || '//' ELSE url END AS input,
  CASE page_id % 4 WHEN 0 THEN page_id || '.txt' WHEN 1 THEN 'https://host' || page_id || '.test?q'
    WHEN 2 THEN 'sub' || page_id ELSE CASE WHEN len(segments) > 2 THEN segments[-1] ELSE url END END AS name
FROM s"""

# Text

per_document("decode_text", "chr(65533) || text || chr(65533)")
per_document("strip_bom", "CASE WHEN doc_id % 3 = 2 THEN chr(65279) ELSE '' END || text")
NOISY = f"replace(replace(text, {NL}, ' ' || chr(9) || repeat(chr(13) || {NL}, 3)), '. ', '.' || chr(9) || ' ' || chr(13))"
per_document("normalize_markdown", norm(NOISY))
per_document("decode_entities", "text || '&bogus;&#x110000; ' || chr(8212) || chr(128512) || '&lt;'")
per_page("strip_tags", sub("html", "<[^>]+>"))
per_document("escape_cell", cell("' |' || text"))
per_document(
    "fence_text",
    f"repeat('`', greatest(3, doc_id % 6 + 1)) || 'txt' || {NL} || repeat('`', doc_id % 6) || {rtrim('text')} || {NL} "
    "|| repeat('`', greatest(3, doc_id % 6 + 1))",
)
per_document(
    "xml_to_text",
    f"array_to_string(list_filter(list_transform({LINES}, lambda line: {trim('line')}), lambda line: line <> ''), {NL})",
)
ORACLES["plain_to_markdown"] = f"""
SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 'binary' ELSE 'ok' END AS status,
  CASE WHEN doc_id % 50 <> 0 THEN {norm(f"replace(text, {NL}, {PARA})")} END AS markdown
FROM documents"""
ORACLES["json_to_markdown"] = f"""
SELECT event_id, '```json' || {NL} || '{{' || {NL} || '  "k": ' || regexp_extract(props, '[0-9.-]+') || {NL} || '}}' ||
  {NL} || '```' AS markdown
FROM events"""

# HTML

per_page("html_drop_blocks", drop_blocks("html"))
per_page("html_breaks", breaks(f"html || '<HR><br' || {NL} || '/>'"))
per_page("html_blocks", blocks("html"))
ORACLES["html_to_markdown"] = f"WITH {PAGE_MARKDOWN} SELECT page_id, markdown FROM page_md"
per_page("html_inline", f"{sub(links('html'), '<[^>]+>')} || '![pic]()**s***it*`c`y'")
FIRST = f"{LINES}[1]"
per_document(
    "html_headings",
    f"{PARA} || repeat('#', doc_id % 6 + 1) || ' ' || {squeeze(f'''concat('**', {FIRST}, '**')''')} || {PARA} || {escaped('text')}",
)
TABLE_ROWS = text_list(
    f"'| ' || i || ' | ' || CASE WHEN i % 3 <> 2 THEN replace({squeeze(chr(39) + '**' + chr(39) + ' || line || ' + chr(39) + '**' + chr(39))}, '|', '\\|') ELSE '' END || ' |' "
    f"|| CASE WHEN i = 0 THEN {NL} || '| --- | --- |' ELSE '' END"
)
per_document("html_tables", f"'x' || {PARA} || {TABLE_ROWS} || {PARA} || 'y'")
per_document("html_pre", f"'a' || {PARA} || '```' || {NL} || trim({escaped('text')}, {NL}) || {NL} || '```' || {PARA} || 'b'")
per_document("html_blockquote", f"{PARA} || " + text_list(f"'> ' || {trim(escaped('line'))}") + f" || {PARA}")
LIST_ITEMS = text_list(
        f"{NL} || '- ' || CASE WHEN i % 2 = 1 THEN CASE WHEN {trim('line')} = '' THEN '' ELSE '[' || {squeeze('line')} || '](/' || i || ')' END "
        f"ELSE {squeeze('line')} END",
        "''",
    )
per_document("html_lists", f"'<ul>' || {LIST_ITEMS} || {PARA}")
per_document("inline_text", squeeze(f"'*' || {FIRST} || '* ' || CASE WHEN {trim('text')} = '' THEN '' ELSE '[' || {trim('text')} || '](/u)' END"))

# Tables and spreadsheets

ORACLES["markdown_table"] = f"""
WITH r AS (
  SELECT l_orderkey, row_number() OVER w AS n, l_linenumber % 3 + 1 AS k, max(l_linenumber % 3 + 1) OVER (PARTITION BY l_orderkey) AS width,
    [CAST(l_linenumber AS VARCHAR), l_returnflag || '\\|' || l_linestatus, CAST(l_partkey AS VARCHAR)] AS cells
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
  t AS (
    SELECT l_orderkey, n, '| ' || cells[1] || ' |' || CASE WHEN width > 1 THEN ' ' || CASE WHEN k > 1 THEN cells[2] ELSE '' END || ' |' ELSE '' END
      || CASE WHEN width > 2 THEN ' ' || CASE WHEN k > 2 THEN cells[3] ELSE '' END || ' |' ELSE '' END
      || CASE WHEN n = 1 THEN {NL} || repeat('| --- ', CAST(width AS BIGINT)) || '|' ELSE '' END AS line
    FROM r)
SELECT l_orderkey, string_agg(line, {NL} ORDER BY n) AS markdown FROM t GROUP BY l_orderkey"""

ORACLES["markdown_pieces"] = f"""
WITH r AS (
  SELECT l_returnflag, row_number() OVER w AS n, l_linenumber % 3 + 1 AS k, max(l_linenumber % 3 + 1) OVER (PARTITION BY l_returnflag) AS width,
    [CAST(l_orderkey AS VARCHAR), l_linestatus || '\\|', CAST(l_partkey AS VARCHAR)] AS cells
  FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus)),
  t AS (
    SELECT l_returnflag, n, '| ' || cells[1] || ' |' || CASE WHEN width > 1 THEN ' ' || CASE WHEN k > 1 THEN cells[2] ELSE '' END || ' |' ELSE '' END
      || CASE WHEN width > 2 THEN ' ' || CASE WHEN k > 2 THEN cells[3] ELSE '' END || ' |' ELSE '' END
      || CASE WHEN n = 1 THEN {NL} || repeat('| --- ', CAST(width AS BIGINT)) || '|' ELSE '' END AS line
    FROM r),
  c AS (
    SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY l_returnflag ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {PIECE_CHARS // 2} AS piece
    FROM t),
  p AS (SELECT l_returnflag, piece, string_agg(line, {NL} ORDER BY n) AS markdown FROM c GROUP BY l_returnflag, piece)
SELECT l_returnflag, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY piece) - 1 AS BIGINT) AS piece_no,
  CAST(length(markdown) AS BIGINT) AS chars, md5(markdown) AS digest
FROM p"""

CSV_ROWS = text_list(
    f"'| ' || i || ' | ' || {cell('line')} || ' | ' || CASE WHEN i % 3 = 0 THEN 'extra' ELSE '' END || ' |' "
    f"|| CASE WHEN i = 0 THEN {NL} || '| --- | --- | --- |' ELSE '' END"
)
for _name in ("csv_to_markdown", "tsv_to_markdown"):
    ORACLES[_name] = f"SELECT doc_id, {CSV_ROWS} AS markdown FROM documents"

ORACLES["ordered_parts"] = """
WITH p AS (
  SELECT CAST(doc_id // 10 AS BIGINT) AS doc_id, CAST(doc_id % 10 AS BIGINT) AS entry_idx, CASE WHEN doc_id % 10 = 0 THEN ''
    ELSE CAST(doc_id * 7 % 10 * 4 AS VARCHAR) || repeat('3', CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 18 ELSE 398 END) END AS digits
  FROM documents
), n AS (
  SELECT *, CASE WHEN digits = '' THEN '2' ELSE ltrim(digits, '0') END AS number FROM p
)
SELECT doc_id, entry_idx, 'p2/slide' || digits || '.xml' AS part, CASE WHEN number = '' THEN '0' WHEN len(number) <= 38 THEN number END AS part_no,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY len(number), number, entry_idx) - 1 AS BIGINT) AS pos
FROM n"""
ORACLES["shared_strings"] = f"WITH {BY_LINE} SELECT doc_id, CAST(i AS BIGINT) AS idx, line AS value FROM l"
ORACLES["sheet_names"] = f"SELECT doc_id, CAST(0 AS BIGINT) AS pos, {FIRST} AS name FROM documents"
LETTERS = """CASE p_partkey % 5 WHEN 0 THEN chr(CAST(65 + p_partkey % 26 AS INTEGER))
  WHEN 1 THEN chr(CAST(65 + p_partkey // 26 % 26 AS INTEGER)) || chr(CAST(65 + p_partkey % 26 AS INTEGER))
  WHEN 2 THEN chr(CAST(65 + p_partkey // 676 % 26 AS INTEGER)) || chr(CAST(65 + p_partkey // 26 % 26 AS INTEGER)) || chr(CAST(65 + p_partkey % 26 AS INTEGER))
  WHEN 3 THEN '' ELSE 'AAAAAAAAAA' END"""
ORACLES["column_index"] = f"""
SELECT p_partkey, {LETTERS} AS letters, CAST(CASE p_partkey % 5 WHEN 0 THEN p_partkey % 26
  WHEN 1 THEN (p_partkey // 26 % 26 + 1) * 26 + p_partkey % 26
  WHEN 2 THEN (p_partkey // 676 % 26 + 1) * 676 + (p_partkey // 26 % 26 + 1) * 26 + p_partkey % 26
  WHEN 3 THEN -1 END AS BIGINT) AS col_no
FROM part"""
# Row of a line in the built sheet: every fourth line is followed by an empty row.
SHEET_ROW = "i + i // 4"
SHEET_CELLS = f"""
  c AS (
    SELECT doc_id, {SHEET_ROW} AS row_no, 3 AS col_no, 0 AS cell_pos, 'inlineStr' AS type, substr(line, 1, 5) AS raw, substr(line, 1, 5) AS value FROM l
    UNION ALL SELECT doc_id, {SHEET_ROW}, 0, 1, '', '0', '0' FROM l
    UNION ALL SELECT doc_id, {SHEET_ROW}, 0, 2, '', CAST(i + 1 AS VARCHAR), CAST(i + 1 AS VARCHAR) FROM l
    UNION ALL SELECT doc_id, {SHEET_ROW}, 1, 3, 's', CAST(i AS VARCHAR), line FROM l
    UNION ALL SELECT doc_id, len({LINES}) + len({LINES}) // 4, 25, 0, '', ' ', ' ' FROM documents
    UNION ALL SELECT doc_id, len({LINES}) + len({LINES}) // 4 + 1, 0, 0, 's', '999999999', '' FROM documents)"""
CELL_KEYS = "doc_id, CAST(1 AS BIGINT) AS sheet_pos, CAST(row_no AS BIGINT) AS row_no, CAST(col_no AS BIGINT) AS col_no, CAST(cell_pos AS BIGINT) AS cell_pos"
ORACLES["sheet_cells"] = f"WITH {BY_LINE}, {SHEET_CELLS} SELECT {CELL_KEYS}, type, raw FROM c"
ORACLES["resolve_cells"] = f"WITH {BY_LINE}, {SHEET_CELLS} SELECT {CELL_KEYS}, value FROM c"
SHEET_ROWS = text_list(
    f"'| ' || (i + 1) || ' | ' || {cell('line')} || ' |  | ' || {cell('substr(line, 1, 5)')} || ' |' "
    f"|| CASE WHEN i = 0 THEN {NL} || '| --- | --- | --- | --- |' ELSE '' END "
    f"|| CASE WHEN i % 4 = 3 AND i + 1 < len({LINES}) THEN {NL} || '|  |  |  |  |' ELSE '' END"
)
ORACLES["sheet_to_markdown"] = f"SELECT doc_id, CAST(1 AS BIGINT) AS sheet_pos, {SHEET_ROWS} AS markdown FROM documents"
ORACLES["xlsx_to_markdown"] = f"""
SELECT doc_id, 'ok' AS status, {norm(f"'## ' || {FIRST} || {PARA} || '_(empty sheet)_' || {PARA} || '## Sheet2' || {PARA} || {SHEET_ROWS}")} AS markdown
FROM documents"""

# Other documents

PARAGRAPH = f"CASE WHEN {trim('line')} = '' THEN '' ELSE CASE WHEN i = 0 THEN '# ' WHEN i % 4 = 1 THEN '- ' ELSE '' END || {trim('line')} END"
WORD_TABLE = text_list(
    f"'| ' || i || ' | ' || {cell('line')} || ' |' || CASE WHEN i = 0 THEN {NL} || '| --- | --- |' ELSE '' END"
)
ORACLES["docx_blocks"] = f"""
WITH {BY_LINE},
  b AS (
    SELECT doc_id, i AS place, 'paragraph' AS kind, {PARAGRAPH} AS markdown FROM l
    UNION ALL SELECT doc_id, 1000000000, 'table', {WORD_TABLE} FROM documents
    UNION ALL SELECT doc_id, 1000000001, 'paragraph', 'end' || chr(9) || '.' FROM documents)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS BIGINT) AS block_no, kind, markdown
FROM b WHERE markdown <> ''"""
ORACLES["docx_paragraph"] = f"WITH {BY_LINE} SELECT doc_id, CAST(i AS BIGINT) AS line_no, {PARAGRAPH} AS result FROM l"
ORACLES["docx_run_text"] = f"""
WITH {BY_LINE} SELECT doc_id, CAST(i AS BIGINT) AS line_no, line || chr(9) || '<' || {NL} AS result FROM l"""
per_document("docx_table", WORD_TABLE)
WORD_BLOCKS = f"array_to_string(list_filter({each_line(PARAGRAPH)}, lambda p: p <> ''), {PARA})"
WORD_TEXT = norm(f"{WORD_BLOCKS} || {PARA} || {WORD_TABLE} || {PARA} || 'end' || chr(9) || '.'")
ORACLES["docx_to_markdown"] = f"SELECT doc_id, 'ok' AS status, {WORD_TEXT} AS markdown FROM documents"
SLIDE = f"list_filter(list_transform({LINES}, lambda line: {trim('line')}), lambda line: line <> '')"
ORACLES["pptx_to_markdown"] = f"""
WITH s AS (
  SELECT doc_id // 10 AS deck, doc_id, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS n,
    CASE WHEN len({SLIDE}) = 0 THEN '_(no text)_' ELSE array_to_string({SLIDE}, {PARA}) END AS body
  FROM documents)
SELECT CAST(deck AS BIGINT) AS doc_id, 'ok' AS status,
  {norm(f"string_agg('## Slide ' || (2 * n - 1) || {PARA} || body || {PARA} || '## Slide ' || (2 * n) || {PARA} || '_(no text)_', {PARA} ORDER BY doc_id)")} AS markdown
FROM s GROUP BY deck"""
ORACLES["epub_spine"] = """
SELECT CAST(page_id // 10 AS BIGINT) AS doc_id,
  CAST(1 + row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id DESC) AS BIGINT) AS pos, 'OEBPS/ch ' || page_id || '.xhtml' AS part
FROM pages
UNION ALL SELECT DISTINCT CAST(page_id // 10 AS BIGINT), CAST(0 AS BIGINT), 'OEBPS/absent%.xhtml' FROM pages"""
ORACLES["epub_to_markdown"] = f"""
WITH {PAGE_MARKDOWN}
SELECT CAST(page_id // 10 AS BIGINT) AS doc_id, 'ok' AS status,
  {norm(f"string_agg(markdown, {PARA} ORDER BY page_id DESC)")} AS markdown
FROM page_md WHERE markdown <> '' GROUP BY page_id // 10"""
ORACLES["notebook_to_markdown"] = f"""
SELECT conv_id, CAST(turn // 8 AS BIGINT) AS part, 'ok' AS status,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN '```python' || {NL} || {rtrim('text')} || {NL} || '```' ELSE {trim('text')} END, {PARA} ORDER BY turn)
    FILTER (WHERE role <> 'system' AND {trim('text')} <> ''), '') AS markdown
FROM conversations GROUP BY conv_id, turn // 8"""

# Whole jobs, engines, results

ORACLES["convert_documents"] = f"""
WITH {PAGE_MARKDOWN},
  r AS (
    SELECT 'txt' || doc_id AS doc_id, 'file' AS kind, 'text' AS format, 'ok' AS status, {norm('text')} AS markdown FROM documents
    UNION ALL SELECT 'pdf' || doc_id, 'file', 'unsupported', 'unsupported', NULL FROM documents
    UNION ALL SELECT 'web' || page_id, 'url', 'html', 'ok', markdown FROM page_md
    UNION ALL SELECT 'docx' || doc_id, 'file', 'docx', status, markdown FROM ({ORACLES['docx_to_markdown']})
    UNION ALL SELECT 'xlsx' || doc_id, 'file', 'xlsx', status, markdown FROM ({ORACLES['xlsx_to_markdown']})
    UNION ALL SELECT 'pptx' || doc_id, 'file', 'pptx', status, markdown FROM ({ORACLES['pptx_to_markdown']})
    UNION ALL SELECT 'epub' || doc_id, 'file', 'epub', status, markdown FROM ({ORACLES['epub_to_markdown']})
    UNION ALL SELECT 'ipynb' || conv_id || '-' || part, 'file', 'ipynb', status, markdown FROM ({ORACLES['notebook_to_markdown']})
    UNION ALL SELECT 'csv' || doc_id, 'file', 'csv', 'ok', markdown FROM ({ORACLES['csv_to_markdown']})
    UNION ALL SELECT 'tsv' || doc_id, 'file', 'tsv', 'ok', markdown FROM ({ORACLES['tsv_to_markdown']})
    UNION ALL SELECT 'xml' || doc_id, 'file', 'xml', 'ok', {norm('result')} FROM ({ORACLES['xml_to_text']})
    UNION ALL SELECT 'json' || event_id, 'file', 'json', 'ok', markdown FROM ({ORACLES['json_to_markdown']}))
SELECT doc_id, kind, format, status, CAST(length(markdown) AS BIGINT) AS chars, false AS truncated, markdown
FROM r"""

ORACLES["convert_inputs"] = f"""
WITH wanted AS (
  SELECT doc_id, CASE WHEN doc_id % 8 = 6 THEN 'url' ELSE 'file' END AS kind, html,
    CASE WHEN doc_id % 8 = 4 THEN 'empty_input' WHEN doc_id % 8 IN (5, 6) AND page_id IS NOT NULL THEN 'not_found' WHEN doc_id % 8 = 6 THEN 'not_found'
      WHEN page_id IS NULL THEN 'empty_input' WHEN doc_id % 8 = 3 THEN 'not_a_file'
      WHEN octet_length(encode(html)) + 1 > {MAX_BYTES} THEN 'too_large' ELSE 'ok' END AS status
  FROM documents LEFT JOIN pages ON page_id = doc_id // 4)
SELECT doc_id, kind, status, CASE WHEN status = 'ok' THEN 'text' END AS format,
  CASE WHEN status = 'ok' THEN CAST(length({norm('html')}) AS BIGINT) END AS chars, CASE WHEN status = 'ok' THEN {norm('html')} END AS markdown
FROM wanted"""

CANDIDATES = f"""
  have AS (
    SELECT doc_id, text, e AS engine, i AS place FROM documents, (VALUES {", ".join(f"('{e}', {i})" for i, e in enumerate(ENGINES))}) AS v(e, i)
    WHERE (i >= doc_id % 4 AND (i + doc_id) % 3 <> 0) OR e = 'builtin'),
  k AS (
    SELECT doc_id, engine, place, CASE WHEN doc_id % 13 = 0 THEN 'empty_output' ELSE 'ok' END AS status,
      CASE WHEN doc_id % 13 <> 0 THEN {norm(f"engine || ': ' || text || {PARA} || 'end'")} END AS markdown,
      'warn ' || doc_id AS stderr,
      CASE WHEN doc_id % 13 = 0 THEN engine || ' produced no Markdown: Downloading x' || {NL} || 'warn ' || doc_id END AS error
    FROM have)"""
ORACLES["clean_external_markdown"] = f"WITH {CANDIDATES} SELECT doc_id, engine, status, markdown, stderr, error FROM k"
ORACLES["select_engine"] = f"""
WITH {CANDIDATES},
  best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS n FROM k)
SELECT doc_id, 'auto' AS choice, engine, status, markdown, stderr, error FROM best WHERE n = 1
UNION ALL
SELECT d.doc_id, 'uvx', 'uvx', coalesce(k.status, 'engine_unavailable'), k.markdown, k.stderr,
  CASE WHEN k.engine IS NULL THEN 'engine "uvx" is not available' ELSE k.error END
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id AND k.engine = 'uvx'"""
per_document("filter_engine_noise", trim(text_list(rtrim("'> ' || line"))))
RESULTS = f"""
  r AS (
    SELECT doc_id, text, 'd' || doc_id || '.txt' AS input, {pick(('text', 'html'), 'doc_id')} AS format, {pick(ENGINES, 'doc_id')} AS engine,
      CASE WHEN doc_id % 3 = 0 THEN '/out/' || doc_id || '.md' END AS output_path, CAST(length(text) AS BIGINT) AS chars,
      coalesce(doc_id % 3 <> 0 AND length(text) > {MAX_CHARS}, false) AS truncated,
      CASE WHEN doc_id % 2 = 0 THEN '{REMEDY}' || {NL} ELSE '' END ||
      CASE WHEN doc_id % 5 <> 0 AND doc_id % 700 > 0 THEN 'engine stderr: ' || repeat('e', least(doc_id % 700, 600)) ||
        CASE WHEN doc_id % 700 > 600 THEN chr(8230) ELSE '' END || {NL} ELSE '' END ||
      CASE WHEN doc_id % 3 = 0 THEN 'All of the Markdown was written to /out/' || doc_id ||
        '.md; open that file rather than converting anew.' || {NL} ELSE '' END AS noted
    FROM documents)"""
ORACLES["truncate_result"] = f"""
WITH {RESULTS} SELECT doc_id, output_path, chars, truncated, CASE WHEN truncated THEN substr(text, 1, {MAX_CHARS}) ELSE text END AS markdown FROM r"""
ORACLES["compose_notes"] = f"WITH {RESULTS} SELECT doc_id, nullif(rtrim(noted, {NL}), '') AS notes FROM r"
ORACLES["render_result"] = f"""
WITH {RESULTS}
SELECT doc_id, 'Converted ' || input || ' with ' || engine || ' ' || chr(8212) || ' ' ||
  CASE WHEN output_path IS NULL THEN chars || ' characters of Markdown.' ELSE 'wrote ' || chars || ' characters to ' || output_path || '.' END ||
  CASE WHEN truncated THEN {NL} || '[Output truncated to {MAX_CHARS} characters. Re-run with an "output" path to capture the whole document.]' ELSE '' END ||
  CASE WHEN noted = '' THEN '' ELSE {NL} || rtrim(noted, {NL}) END ||
  CASE WHEN output_path IS NULL AND text <> '' THEN {PARA} || CASE WHEN truncated THEN substr(text, 1, {MAX_CHARS}) ELSE text END ELSE '' END AS result
FROM r"""
ORACLES["conversion_report"] = f"""
WITH {RESULTS}, s AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'empty_output' ELSE 'ok' END AS status FROM r)
SELECT engine, format, status, CAST(grouping(engine, format, status) AS BIGINT) AS level, count(*) AS documents,
  CAST(coalesce(sum(chars), 0) AS BIGINT) AS chars, CAST(count(*) FILTER (WHERE truncated) AS BIGINT) AS truncated
FROM s GROUP BY ROLLUP (engine, format, status)"""
ORACLES["stream_documents"] = f"""
SELECT page_id, 'text' AS format, 'ok' AS status, CAST(length({norm('html')}) AS BIGINT) AS chars, {norm('html')} AS markdown FROM pages"""
