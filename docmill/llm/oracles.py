"""The results of the queries that SQL can express, over the same tables."""

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('+' || source, '-') AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, host, doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM docs
), windows AS (
  SELECT r, i, list_slice(w, i, i + 7) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range(8) AS t(k) GROUP BY r
), lines AS (
  SELECT r, host, name, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS filled,
    array_to_string(regexp_extract_all(regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[0-9]', '0', 'g'), '{WORD}'), ' ') AS plain,
    len(regexp_extract_all(line, '{WORD}')) AS n
  FROM (SELECT r, host, coalesce('i' || CAST(doc_id AS VARCHAR), 't' || text) AS name, unnest(string_split(text, chr(10))) AS line FROM docs)
), dup AS (
  SELECT r, count(*) FILTER (filled) - count(DISTINCT line) FILTER (filled) AS n FROM lines GROUP BY r
), above AS (
  SELECT host, plain FROM lines WHERE filled GROUP BY host, plain HAVING count(DISTINCT name) > 20
), removed AS (
  SELECT r, sum(n) AS n FROM lines JOIN above USING (host, plain) WHERE filled GROUP BY r
), facts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(dup.n AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM words LEFT JOIN dup USING (r) LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= 0.2 * n_words AS kept
FROM facts
"""

MIXING = f"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496)
      / greatest(0.05::DOUBLE, coalesce(length(regexp_replace(text, '[^a-z]+', '', 'g')) / nullif(length(text), 0), 0.05)) AS key
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
), ranked AS (
  SELECT *, list_extract([5, 2, 1], CAST((place - 1) % 3 + 1 AS INT)) AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes)
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (tight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
    / CAST(sum(weight) OVER (tight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level,
    row_number() OVER tight AS turn
  FROM ranked WINDOW tight AS (ORDER BY source_size / weight, place)
), settled AS (
  SELECT min(turn) AS turn, arg_min(level, turn) AS level FROM levels WHERE level * weight <= 3 * source_size
), goals AS (
  SELECT source, source_size,
    CASE WHEN s.turn IS NULL OR l.turn < s.turn THEN CAST(3 * source_size AS DOUBLE) ELSE s.level * weight END AS target
  FROM levels l, settled s
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS epochs FROM goals
), sums AS (
  SELECT r.*, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size AS rest,
    CAST(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM rows r JOIN budgets g ON r.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  size * epochs + CASE WHEN upto + upto - size <= 2 * rest THEN size ELSE 0 END AS taken
FROM sums
"""

WARC = """
WITH facts AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM facts
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

VECTORS = """
WITH RECURSIVE flat AS (
  SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), good AS (
  SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM flat
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM embeddings
"""

JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, list_slice(w, i, i + 3) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
  )
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS first FROM reach GROUP BY a) USING (doc_id)
"""

def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds of Lloyd by comparing every part with every entry, ties by the lower index."""
    distance = "list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y)"

    def near(i: int) -> str:
        return f"""near{i} AS MATERIALIZED (
  SELECT vec_id, p, min(CAST({distance} AS BIGINT) * {entries} + e) AS best FROM parts JOIN book{i} USING (p) GROUP BY ALL
)"""

    def moved(i: int) -> str:
        return f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM book{i} b LEFT JOIN (
    SELECT p, e, list(CAST(floor(s / n) AS DOUBLE) ORDER BY i) AS y FROM (
      SELECT p, best % {entries} AS e, i, sum(x[i]) AS s, count(*) AS n
      FROM near{i} JOIN parts USING (vec_id, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS i) GROUP BY ALL
    ) GROUP BY ALL
  ) m USING (p, e)
)"""

    steps = ", ".join(f"{near(i)}, {moved(i)}" for i in range(rounds))
    return f"""
WITH good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM good, (SELECT unnest(range({parts})) AS p)
), book0 AS MATERIALIZED (
  SELECT p, e, x AS y FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {entries}
), {steps}, {near(rounds)}, coded AS (
  SELECT vec_id, lower(string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY p)) AS code,
    CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(CAST(CAST(z AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(y) AS z, generate_subscripts(y, 1) AS i FROM book{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN good USING (vec_id), books
"""


def crc32_of(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    return (
        f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT)), "
        "lambda acc, b: list_reduce([xor(acc, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"
    )


def conversations() -> str:
    """The best repair of the first i rows for each state, i growing; a weight is six digits of cost, then the audit."""

    def after(weight: str, cost: str, initial: str) -> str:
        return f"printf('%06d', CAST(left({weight}, 6) AS INTEGER) + {cost}) || substr({weight}, 7) || '{initial}'"

    def given(role: str, weight: str) -> str:
        return f"CASE WHEN letter = 'd' THEN NULL WHEN initial = '{role}' THEN {after(weight, 'more', 'K')} ELSE {after(weight, '3 + more', 'R')} END"

    gone = {q: after(f"i{q}", "4", "D") for q in "0123"}
    to_user = ", ".join(given("u", f"i{q}") for q in "013")
    return f"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_of("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM numbered
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial, rtrim(text, E' \\t\\n\\x0b\\f\\r') AS trimmed FROM damaged
), faults AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), rows AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' ELSE 'k' END AS letter, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM faults
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), steps(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM ids
  UNION ALL
  SELECT p.conv_id, r.i, {gone["0"]},
    least({gone["1"]}, CASE WHEN letter <> 'd' AND initial = 's' THEN {after("i0", "more", "K")} END),
    least({gone["2"]}, {to_user}), least({gone["3"]}, {given("a", "i2")})
  FROM (
    SELECT conv_id, i, s0 AS i0, s1 AS i1, s2 AS i2, least(s3, {after("s2", "3", "I")}) AS i3 FROM (
      SELECT conv_id, i, s0, s1, s3, least(s2, {after("s0", "3", "I")}, {after("s1", "3", "I")}, {after("s3", "3", "I")}) AS s2 FROM steps
    )
  ) p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
), last AS (
  SELECT conv_id, least(s0, s3, {after("s2", "3", "I")}, {after(after("s1", "3", "I"), "3", "I")}, {after(after("s0", "3", "I"), "3", "I")}) AS weight
  FROM steps WHERE (conv_id, i) IN (SELECT (conv_id, max(i)) FROM steps GROUP BY conv_id)
), audits AS (
  SELECT conv_id, CAST(left(weight, 6) AS BIGINT) AS cost, substr(weight, 7) AS audit, len(replace(substr(weight, 7), 'D', '')) % 2 AS odd FROM last
), letters AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS place
  FROM (SELECT conv_id, odd, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p FROM audits WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), repaired AS (
  SELECT l.conv_id, string_agg(CASE WHEN edit = 'K' THEN r.role WHEN (place + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY place) AS lines
  FROM letters l LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE edit <> 'D' GROUP BY l.conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


ORACLES = {"op2_quality_rules": QUALITY, "op4_mixing": MIXING, "op5_embedding_dedup": VECTORS, "op7_warc": WARC, "op8_ngram_join": JOIN, "op11_vector_codes": vector_codes(), "op12_conversation_repair": conversations()}
