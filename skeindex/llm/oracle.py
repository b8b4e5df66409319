"""SQL for the registered queries that SQL can express."""

from skeindex.llm import lines, warc


def _text(sql: str) -> str:
    return sql.replace("'", "''")


def _decoded(sql: str) -> str:
    for name, char in warc.ENTITIES:
        sql = f"replace({sql}, '{_text(name)}', '{_text(char)}')"
    return sql


def _one_line(sql: str) -> str:
    return rf"trim(regexp_replace({sql}, '[ \t\r\n\f]+', ' ', 'g'))"


def _uuid(sql: str) -> str:
    parts = "|| '-' ||".join(f"substr(md5({sql}), {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {parts} || '>')"


# The patterns of pages as DuckDB takes them, which knows no possessive groups and needs none.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
ATTRIBUTE = r"""([^\s>/=][^\s=>/]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)?"""
LINK_TAG = rf"(?i)<(?:a|area)((?:[\s/](?:[\s/]+|=|{ATTRIBUTE})*))"
TARGETS = f"""[regexp_replace(y, '^["''](.*)["'']$', '\\1', 's') FOR y IN [
  list_filter(list_zip(regexp_extract_all(tag, '{_text(ATTRIBUTE)}', 1), regexp_extract_all(tag, '{_text(ATTRIBUTE)}', 2)), lambda x: lower(x[1]) = 'href' AND x[2] <> '')[1][2]
  FOR tag IN regexp_extract_all(visible, '{_text(LINK_TAG)}', 1)] IF y IS NOT NULL]"""
CRLF = "chr(13) || chr(10)"
DERIVED = rf"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, coalesce(url, '') AS target_uri,
         regexp_replace(coalesce(html, ''), '{_text(HIDDEN)}', '', 'g') AS visible FROM pages
), r AS (
  SELECT *, {_uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || target_uri")} AS refers_to,
         {TARGETS} AS links,
         regexp_replace(regexp_replace(regexp_replace(visible, '[ \t\r\n\f]+', ' ', 'g'), '{_text(warc.LINE_TAG)}', chr(10), 'g'), '{_text(warc.TAG)}', '', 'g') AS t
  FROM p
), b AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'title: ' || {_one_line(_decoded(f"regexp_extract(visible, '{_text(warc.TITLE)}', 1)"))} || {CRLF} || 'outlinks: ' || len(links) || {CRLF}
         || array_to_string([('outlink: ' || {_one_line(_decoded("x"))} || {CRLF}) FOR x IN links], '') AS block
  FROM r
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=UTF-8',
         regexp_replace(regexp_replace({_decoded("t")}, ' *\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')
  FROM r
)
SELECT page_id, record_type, {_uuid("record_type || '|' || refers_to")} AS record_id, refers_to, target_uri, '1970-01-01T00:00:00Z' AS date, content_type,
       'HTTP/1.1 200 OK' || {CRLF} || 'Content-Type: text/html; charset=utf-8' || {CRLF} || 'Content-Length: ' || strlen(body) || {CRLF} AS source_headers,
       'sha256:' || sha256(body) AS source_digest, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length, block
FROM b
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3.0::DOUBLE * source_size) OVER w, 0) AS capped, coalesce(sum(weight) OVER w, 0) AS capped_weight
  FROM s WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max((total - capped) / (weights - capped_weight)) AS level FROM f
  WHERE (total - capped) / (weights - capped_weight) * weight <= cap
), t AS (
  SELECT source, source_size, least(cap, level * weight) AS target,
         CASE WHEN source_size > 0 THEN least(floor(least(cap, level * weight) / source_size), 3) ELSE 0 END::BIGINT AS rounds
  FROM f, level
), c AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h)
), k AS (
  SELECT c.source, max(c.h) AS threshold FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WHERE t.target - t.rounds * t.source_size > 0 AND c.before + c.words / 2.0 <= t.target - t.rounds * t.source_size
  GROUP BY c.source
)
SELECT d.doc_id, d.size::BIGINT AS size, t.source_size, t.target, d.source,
       (t.rounds + (d.h <= coalesce(k.threshold, -1))::INT)::INT AS copies,
       (d.size * (t.rounds + (d.h <= coalesce(k.threshold, -1))::INT))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""

# A normalised line; the texts' white space is ASCII.
PLAIN = r"trim(regexp_replace(lower(line), '\s+', ' ', 'g'))"

WINDOWS = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents
), p AS (
  SELECT doc_id, i, {PLAIN} AS line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE {PLAIN} <> ''
), w AS (
  SELECT a.doc_id, a.k, a.i AS first, c.i AS last, md5(a.line || chr(10) || b.line || chr(10) || c.line) AS h
  FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN p c ON a.doc_id = c.doc_id AND c.k = a.k + 2
), later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, k) AS n FROM w) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM later
), d AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(g.i::VARCHAR, ',' ORDER BY l.i), '') AS removed_lines,
         md5(coalesce(string_agg(CASE WHEN g.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '')) AS text_md5
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)
SELECT * FROM d
"""

# Sentence-sized units that repeat, in runs of consecutive ones with enough words.
PASSAGES = rf"""
WITH l AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '{lines.PIECE}')) AS line, generate_subscripts(regexp_extract_all(text, '{lines.PIECE}'), 1) - 1 AS i FROM documents
), o AS (
  SELECT *, (sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i) - length(line))::BIGINT AS start, {PLAIN} AS plain FROM l
), h AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS unit, start, start + length(line) AS "end", md5(plain) AS digest,
         len(string_split(plain, ' ')) AS words
  FROM o WHERE plain <> ''
), r AS (
  SELECT *, row_number() OVER w AS n, first_value(doc_id) OVER w AS kept_doc_id, first_value(unit) OVER w AS kept_unit
  FROM h WINDOW w AS (PARTITION BY digest ORDER BY doc_id, unit)
), runs AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM r WHERE n > 1
)
SELECT doc_id, unit, start, "end", digest, kept_doc_id, kept_unit FROM runs
QUALIFY sum(words) OVER (PARTITION BY doc_id, run) >= {lines.PASSAGE_WORDS}
"""

# crc32 of a decimal number: eight steps for each byte; DuckDB has no such function.
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


def _crc32(sql: str) -> str:
    step = "xor(c, b)"
    for _ in range(8):
        step = f"list_reduce([{step}, 0::BIGINT], lambda c, z: {_STEP})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], [ord(ch)::BIGINT FOR ch IN string_split({sql}, '')]), lambda c, b: {step}), 4294967295::BIGINT)"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# Trees of three: the nodes of all levels, then every leaf's way up with its siblings.
MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
  FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d
), t AS (
  SELECT source, 0 AS level, pos, leaf AS h, n FROM l
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY source, level, pos // 3
), sub AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY level, pos // 3
), runs AS (
  SELECT source, level, pos // 3 AS run, list(h ORDER BY pos) AS hs, any_value(n) AS n FROM t GROUP BY source, level, pos // 3
), tops AS (
  SELECT level, pos // 3 AS run, list(h ORDER BY pos) AS hs, any_value(n) AS n FROM u GROUP BY level, pos // 3
), w AS (
  SELECT doc_id, source, leaf, other AS h, '' AS sib, 0 AS level, pos, n FROM l
  UNION ALL
  SELECT doc_id, w.source, leaf, sha256(array_to_string(list_concat(hs[:pos % 3], [h], hs[pos % 3 + 2:]), '')),
         sib || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), ''), w.level + 1, pos // 3, (w.n + 2) // 3
  FROM w JOIN runs ON w.source IS NOT DISTINCT FROM runs.source AND w.level = runs.level AND pos // 3 = run WHERE w.n > 1
), x AS (
  SELECT doc_id, w.source, leaf, h, sib, 0 AS level, sub.pos, sub.n, subroot FROM w JOIN sub ON w.source IS NOT DISTINCT FROM sub.source WHERE w.n = 1
  UNION ALL
  SELECT doc_id, source, leaf, sha256(array_to_string(list_concat(hs[:pos % 3], [h], hs[pos % 3 + 2:]), '')),
         sib || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), ''), x.level + 1, pos // 3, (x.n + 2) // 3, subroot
  FROM x JOIN tops ON x.level = tops.level AND pos // 3 = run WHERE x.n > 1
), r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, h AS folded_root, h = root AS verified FROM x, r WHERE n = 1
"""

TOP_K = """
WITH e AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
  FROM e q JOIN e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""

ORACLE = {
    "op1_warc_derivatives": DERIVED,
    "op5_topk_threshold": TOP_K,
    "op3_line_windows": WINDOWS,
    "op4_repeated_lines": PASSAGES,
    "op8_mix_sources": MIX,
    "op12_merkle_manifest": MERKLE,
}
