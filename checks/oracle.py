"""SQL for the registered queries, on the same tables."""

from __future__ import annotations

from skeindex.functions.text import ENGLISH_STOP_WORDS
from skeindex.operators.context import PROMPT_HEAD, PROMPT_QUESTION, PROMPT_TAIL

ORACLE: dict[str, str] = {}

STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tf_of(table: str, key: str, name: str) -> str:
    """CTE ``name(id, term_id, tf)`` over the words of a table."""
    return f"""
    {name}_w AS (SELECT {key} AS id,
        unnest(regexp_extract_all(lower(replace(text, 'İ', 'i')), '[\\p{{L}}\\p{{N}}]+')) AS w
      FROM {table}),
    {name} AS (SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT AS term_id, count(*) AS tf
      FROM {name}_w WHERE w NOT IN ({STOP}) GROUP BY 1, 2)"""


DOC_TF = tf_of("documents", "doc_id", "tf")
CORPUS_TF = tf_of("corpus", "key", "tf")
QUERY_TF = tf_of("benchmark", "item_id", "qtf")
STATS = """
    dl AS (SELECT id, sum(tf) AS len FROM tf GROUP BY id),
    stats AS (SELECT count(*) AS n_docs, avg(len) AS avgdl FROM dl),
    df AS (SELECT term_id, count(*) AS df FROM tf GROUP BY term_id)"""
WEIGHTS = """
    dw AS (SELECT id, term_id, tf / (1.2 * (1 - 0.75 + 0.75 * len / avgdl) + tf) AS weight
      FROM tf JOIN dl USING (id), stats)"""
QUERY_WEIGHTS = """
    idf AS (SELECT q.id AS qid, q.term_id, ln((n_docs + 1) / (coalesce(df, 1) + 0.5)) AS idf
      FROM qtf q LEFT JOIN df USING (term_id), stats),
    qw AS (SELECT qid, term_id, idf / sum(idf) OVER (PARTITION BY qid) AS weight FROM idf)"""
SPARSE = """
    ss AS (SELECT qid, id, round(sum(qw.weight * dw.weight), 6) AS score
      FROM dw JOIN qw USING (term_id) GROUP BY qid, id),
    sr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM ss)"""

ORACLE["term_frequency"] = f"WITH {DOC_TF} SELECT id, term_id, tf FROM tf"
ORACLE["bm25_doc_freq"] = f"WITH {DOC_TF}, {STATS} SELECT term_id, df FROM df"
ORACLE["stored_model"] = ORACLE["bm25_doc_freq"]
ORACLE["bm25_stats"] = f"""WITH {DOC_TF}, {STATS}
    SELECT n_docs, round(avgdl, 6) AS avgdl, 1.2::DOUBLE AS k1, 0.75::DOUBLE AS b FROM stats"""
ORACLE["bm25_stats_stemmed"] = ORACLE["bm25_stats"]
ORACLE["bm25_encode_docs"] = f"""WITH {DOC_TF}, {STATS}, {WEIGHTS}
    SELECT id, term_id, round(weight, 6) AS weight FROM dw"""
ORACLE["bm25_encode_queries"] = f"""WITH {DOC_TF}, {QUERY_TF}, {STATS}, {QUERY_WEIGHTS}
    SELECT qid, term_id, round(weight, 6) AS weight FROM qw"""
ORACLE["sparse_topk"] = f"""WITH {DOC_TF}, {QUERY_TF}, {STATS}, {WEIGHTS}, {QUERY_WEIGHTS}, {SPARSE}
    SELECT qid, rank, id, score FROM sr WHERE rank <= 10"""
ORACLE["sparse_topk_join"] = ORACLE["sparse_topk"]
ORACLE["sparse_topk_blocks"] = ORACLE["sparse_topk"]
ORACLE["posting_lists"] = f"""WITH {DOC_TF}, {STATS}, {WEIGHTS}
    SELECT term_id, count(*) AS df, round(max(weight), 6) AS most, round(min(weight), 6) AS least FROM dw GROUP BY term_id"""
ORACLE["sparse_topk_repeated_ids"] = f"""WITH {DOC_TF}, {QUERY_TF}, {STATS}, {WEIGHTS}, {QUERY_WEIGHTS}, {SPARSE},
    h AS (SELECT qid, id // 2 AS id, max(score) AS score FROM ss GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM h)
    SELECT qid, rank, id, score, unnest(['one', 'many']) AS path FROM r WHERE rank <= 10"""

SPELLINGS = """
    sp AS (SELECT doc_id AS id, CASE WHEN lang = 'en' THEN text ELSE '' END AS chunk,
      CASE WHEN lang <> 'de' THEN text END AS text FROM documents),
    co AS (SELECT id, coalesce(nullif(chunk, ''), nullif(text, '')) AS chunk FROM sp)"""
ORACLE["text_coalesce"] = f"""WITH {SPELLINGS}
    SELECT id, md5(chunk) AS digest FROM co WHERE chunk IS NOT NULL"""
ORACLE["doc_ids"] = f"WITH {SPELLINGS} SELECT id FROM co WHERE chunk IS NOT NULL"

MEANS = """
    e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
    x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e),
    m AS (SELECT label, pos, round(avg(x), 6) AS x FROM x GROUP BY label, pos),
    q AS (SELECT label AS qid, list(x ORDER BY pos) AS d FROM m GROUP BY label)"""
for metric, score, order in (
    ("dot", "list_dot_product(v, d)", "DESC"),
    ("cosine", "list_cosine_similarity(v, d)", "DESC"),
    ("l2", "list_distance(v, d)", "ASC"),
):
    ORACLE[f"dense_topk_{metric}"] = f"""WITH {MEANS},
    s AS (SELECT qid, id, round({score}, 6) AS score FROM e, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score {order}, id) AS rank FROM s)
    SELECT qid, rank, id, score FROM r WHERE rank <= 10"""
ORACLE["ann_topk"] = f"""WITH {MEANS},
    c AS (SELECT qid AS cell, d, count(*) OVER () AS n FROM q),
    own AS (SELECT id, cell FROM e, c QUALIFY
      row_number() OVER (PARTITION BY id ORDER BY list_dot_product(v, d) - list_dot_product(d, d) / 2 DESC, cell) = 1),
    near AS (SELECT id AS qid, cell FROM e, c QUALIFY
      row_number() OVER (PARTITION BY id ORDER BY round(list_dot_product(v, d), 6) DESC, cell) <= ceil(n / 10)),
    s AS (SELECT near.qid, own.id, round(list_dot_product(a.v, b.v), 6) AS score
      FROM near JOIN own USING (cell) JOIN e a ON a.id = near.qid JOIN e b ON b.id = own.id),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM s)
    SELECT qid, rank, id, score FROM r WHERE rank <= 10"""
# Ids are text there, which orders ties; scores of stored vectors are rounded more coarsely.
ORACLE["index_ann_topk"] = ORACLE["ann_topk"].replace(
    "SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings",
    "SELECT vec_id::VARCHAR AS id, label, embedding::DOUBLE[] AS v FROM embeddings",
).replace("SELECT qid, rank, id, score FROM r", "SELECT qid, rank, round(score, 4) AS score FROM r")
ORACLE["ann_all_cells"] = ORACLE["dense_topk_dot"]
ORACLE["ann_quantised"] = ORACLE["dense_topk_dot"]
ORACLE["ann_trained"] = "SELECT vec_id AS id, true AS nearest FROM embeddings"
ORACLE["l2_normalize"] = """
    WITH e AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x: x * label) AS v
      FROM embeddings),
    n AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS len FROM e)
    SELECT id, generate_subscripts(v, 1) - 1 AS pos,
      round(unnest(list_transform(v, lambda x: CASE WHEN len > 0 THEN x / len ELSE x END)), 6) AS x
    FROM n"""


def hashed(tf: str, name: str, dims: int) -> str:
    return f"""
    {name}_d AS (SELECT id, (term_id % {dims})::INT AS dim,
        sum(CASE WHEN term_id >> 31 = 1 THEN -tf ELSE tf END)::BIGINT AS v FROM {tf} GROUP BY 1, 2),
    {name} AS (SELECT id, dim, (v / sqrt(sum(v * v) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS x
      FROM {name}_d WHERE v <> 0)"""


ORACLE["hash_embed"] = f"""WITH {DOC_TF}, {hashed("tf", "h", 768)}
    SELECT id, dim, round(x, 6) AS x FROM h"""
ORACLE["model_embed"] = (
    "SELECT doc_id AS id, "
    + ", ".join(f"length(text) - length(replace(text, '{v}', '')) AS {v}" for v in "aeiou")
    + " FROM documents"
)



def fused(ids: str, depth: int, vectors: str = "h") -> str:
    """CTEs up to ``fr(qid, id, rrf, distance, sparse_distance, rank)``; ``ids`` gives all ids."""
    return f"""{QUERY_TF}, {STATS}, {WEIGHTS}, {QUERY_WEIGHTS}, {SPARSE},
    {hashed("tf", "h", 256)}, {hashed("qtf", "g", 256)},
    unit AS (SELECT id, dim, (x / sqrt(sum(x * x) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS x FROM h),
    hit AS (SELECT g.id AS qid, h.id, sum(g.x * h.x) AS s FROM {vectors} h JOIN g USING (dim) GROUP BY 1, 2),
    ds AS (SELECT q.item_id AS qid, d.id, round(coalesce(s, 0), 6) AS score
      FROM ({ids}) d CROSS JOIN benchmark q LEFT JOIN hit ON hit.qid = q.item_id AND hit.id = d.id),
    dr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM ds),
    a AS (SELECT * FROM dr WHERE rank <= {depth}), b AS (SELECT * FROM sr WHERE rank <= {depth}),
    f AS (SELECT coalesce(a.qid, b.qid) AS qid, coalesce(a.id, b.id) AS id,
        round(coalesce(0.5 / (60 + a.rank), 0) + coalesce(0.5 / (60 + b.rank), 0), 9) AS rrf,
        a.score AS distance, b.score AS sparse_distance
      FROM a FULL JOIN b ON a.qid = b.qid AND a.id = b.id),
    fr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rrf DESC, id) AS rank FROM f)"""


FUSED = f"WITH {DOC_TF}, " + fused("SELECT doc_id AS id FROM documents", 25)
ORACLE["hybrid_rrf"] = f"""{FUSED}
    SELECT qid, rank, id, rrf, distance, sparse_distance FROM fr WHERE rank <= 10"""
ORACLE["result_shape"] = f"""{FUSED}
    SELECT qid, rank, id, distance, sparse_distance, lang, source
    FROM fr LEFT JOIN documents ON doc_id = id WHERE rank <= 10"""

HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
ATTRIBUTE = r"""([^\s>/=][^\s=>/]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)?"""
LINK_TAG = rf"(?i)<(?:a|area)((?:[\s/](?:[\s/]+|=|{ATTRIBUTE})*))"
LINKS = f"""
    anchors AS (SELECT url AS src_url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS site,
        unnest(regexp_extract_all(regexp_replace(html, {quoted(HIDDEN)}, '', 'g'), {quoted(LINK_TAG)}, 1)) AS tag FROM pages),
    l AS (SELECT src_url, site, list_filter(list_zip(regexp_extract_all(tag, {quoted(ATTRIBUTE)}, 1), regexp_extract_all(tag, {quoted(ATTRIBUTE)}, 2)),
        lambda x: lower(x[1]) = 'href' AND x[2] <> '')[1][2] AS href FROM anchors),
    links AS (SELECT src_url, site || regexp_replace(replace(trim(href, chr(34) || chr(39)), '&amp;', '&'), '#.*$', '') AS dst_url
      FROM l WHERE NOT starts_with(trim(href, chr(34) || chr(39)), '#'))"""
ORACLE["extract_links"] = f"WITH {LINKS} SELECT src_url, dst_url FROM links"
ORACLE["filter_links"] = f"""WITH {LINKS},
    h AS (SELECT *, lower(regexp_extract(dst_url, '://([^/?#:]*)', 1)) AS host FROM links)
    SELECT src_url, dst_url FROM h WHERE regexp_matches(dst_url, '/[a-z]')
      AND (host IN ('example.com', 'example.net') OR host LIKE '%.example.com' OR host LIKE '%.example.net')
      AND NOT regexp_matches(dst_url, '[.,]$')"""
ORACLE["crawl_frontier"] = f"""WITH {LINKS}
    SELECT DISTINCT dst_url AS url FROM links WHERE dst_url NOT IN (SELECT url FROM pages)"""
ORACLE["link_depth"] = f"""WITH RECURSIVE {LINKS},
    aimed AS (SELECT src_url, ('0x' || substr(md5(dst_url), 1, 8))::BIGINT
        % (SELECT count(*) FROM pages) AS page_id FROM links),
    edges AS (SELECT DISTINCT src_url, url AS dst_url FROM aimed JOIN pages USING (page_id)),
    seeds AS (SELECT min(url) AS url FROM pages GROUP BY regexp_extract(url, '\\.example\\.[a-z]+')),
    r AS (SELECT url, 0 AS depth FROM seeds
      UNION SELECT dst_url, depth + 1 FROM r JOIN edges ON src_url = r.url WHERE depth < 2)
    SELECT url, min(depth) AS depth FROM r GROUP BY url"""

KEYED = """
    k AS (SELECT 'site/' || split_part(list_extract(string_split(url, '/'), -1), '?', 1) || '.html'
        AS source_file, * FROM pages)"""
ORACLE["page_key"] = f"""WITH {KEYED}
    SELECT source_file, url AS original_url, '2024-01-01 00:00:00' AS scrape_time,
      md5(html) AS fingerprint, page_id FROM k"""
STORES = f"""{KEYED},
    st AS (SELECT source_file, url AS original_url, '2024-01-01 00:00:00' AS scrape_time,
        md5(html) AS fingerprint, page_id FROM k WHERE url NOT LIKE '%.net%'
      QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY page_id DESC) = 1),
    inc AS (SELECT source_file, url AS original_url, '2024-02-01 00:00:00' AS scrape_time,
        md5(CASE WHEN length(html) % 2 = 1 THEN html || '<!-- new -->' ELSE html END) AS fingerprint,
        page_id FROM k QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY page_id DESC) = 1),
    ch AS (SELECT inc.* FROM inc LEFT JOIN st USING (source_file)
      WHERE st.fingerprint IS NULL OR st.fingerprint <> inc.fingerprint),
    up AS (SELECT * FROM st WHERE source_file NOT IN (SELECT source_file FROM ch)
      UNION ALL SELECT * FROM ch)"""
ORACLE["changed_pages"] = f"WITH {STORES} SELECT * FROM ch"
ORACLE["upsert_pages"] = f"WITH {STORES} SELECT * FROM up"
ORACLE["page_store"] = f"WITH {STORES} SELECT * EXCLUDE (page_id) FROM up"

ORACLE["strip_script_style"] = """
    WITH s AS (SELECT page_id, regexp_replace(html,
        '(?is)<(?:script|style)\\b.*?</(?:script|style)\\s*>', '', 'g') AS t FROM pages)
    SELECT page_id, md5(t) AS digest, length(t) AS length FROM s"""


def sections(source: str) -> str:
    """CTE ``sec(id, section, h1, h2, h3, text)`` over ``source(id, md)``, line by line."""
    return f"""
    raw AS (SELECT id, string_split(md, chr(10)) AS ls FROM {source}),
    ln AS (SELECT id, generate_subscripts(ls, 1) AS n, trim(unnest(ls)) AS line FROM raw),
    lv AS (SELECT *, CASE WHEN regexp_matches(line, '^#{{1,3}}( .*)?$')
        THEN length(regexp_extract(line, '^#+')) ELSE 0 END AS lvl FROM ln),
    gr AS (SELECT *, trim(substr(line, lvl + 1)) AS title,
        sum((lvl = 1)::INT) OVER w AS g1,
        sum((lvl BETWEEN 1 AND 2)::INT) OVER w AS g2,
        sum((lvl BETWEEN 1 AND 3)::INT) OVER w AS g3,
        sum((lvl > 0 OR line = '')::INT) OVER w AS para
      FROM lv WINDOW w AS (PARTITION BY id ORDER BY n)),
    hd AS (SELECT *,
        max(CASE WHEN lvl = 1 THEN title END) OVER (PARTITION BY id, g1) AS h1,
        max(CASE WHEN lvl = 2 THEN title END) OVER (PARTITION BY id, g2) AS h2,
        max(CASE WHEN lvl = 3 THEN title END) OVER (PARTITION BY id, g3) AS h3 FROM gr),
    ct AS (SELECT *, lag(n) OVER w IS NULL AS first,
        lag(para) OVER w <> para AS moved,
        (h1, h2, h3) IS DISTINCT FROM lag((h1, h2, h3)) OVER w AS changed
      FROM hd WHERE lvl = 0 AND line <> '' WINDOW w AS (PARTITION BY id ORDER BY n)),
    sx AS (SELECT *, sum((changed AND NOT first)::INT) OVER (PARTITION BY id ORDER BY n) AS section,
        CASE WHEN first OR changed THEN '' WHEN moved THEN '  ' || chr(10) ELSE chr(10) END AS sep
      FROM ct),
    sec AS (SELECT id, section, any_value(h1) AS h1, any_value(h2) AS h2, any_value(h3) AS h3,
        string_agg(sep || line, '' ORDER BY n) AS text FROM sx GROUP BY id, section)"""


MARKDOWN = "text"
for letters, mark in (("[A-D]", "#"), ("[E-H]", "##"), ("[I-L]", "###"), ("[M-O]", "####")):
    MARKDOWN = f"regexp_replace({MARKDOWN}, '(?m)^({letters})', '{mark} \\1', 'g')"
ORACLE["header_sections"] = f"""
    WITH src AS (SELECT doc_id AS id, {MARKDOWN} AS md FROM documents), {sections("src")}
    SELECT id, section, h1, h2, h3, md5(text) AS digest FROM sec"""

# Windows by prefix sums: the longest run within 500, then on to the first piece from which at most
# 100 characters repeat and the next piece fits. Words of these tables are far shorter than 500.
CHUNKS = f"""{sections("src")},
    l1 AS (SELECT id, section, generate_subscripts(parts, 1) AS a, unnest(parts) AS part
      FROM (SELECT id, section, string_split(text, chr(10)) AS parts FROM sec)),
    l2 AS (SELECT id, section, a, CASE WHEN a > 1 THEN chr(10) ELSE '' END || part AS piece FROM l1),
    l3 AS (SELECT *, length(piece) >= 500 AS long,
        coalesce(lag(length(piece) >= 500) OVER (PARTITION BY id, section ORDER BY a), true) AS apart
      FROM l2 WHERE piece <> ''),
    l4 AS (SELECT *, sum((long OR apart)::INT) OVER (PARTITION BY id, section ORDER BY a) AS grp FROM l3),
    w1 AS (SELECT id, section, grp, a, generate_subscripts(ws, 1) AS b, unnest(ws) AS w
      FROM (SELECT *, string_split(piece, ' ') AS ws FROM l4 WHERE long)),
    pc AS (SELECT id, section, grp, a, 0 AS b, piece FROM l4 WHERE NOT long
      UNION ALL
      SELECT id, section, grp, a, b, CASE WHEN b > 1 THEN ' ' ELSE '' END || w FROM w1
      WHERE b > 1 OR w <> ''),
    pp AS (SELECT *, sum(length(piece)) OVER (PARTITION BY id, section, grp ORDER BY a, b) AS till FROM pc),
    gp AS (SELECT id, section, grp, [0::HUGEINT] || list(till ORDER BY a, b) AS e,
        list(piece ORDER BY a, b) AS ps FROM pp GROUP BY id, section, grp),
    st AS (SELECT id, section, grp, 0 AS c, 0 AS s,
        len(list_filter(e, lambda x: x <= 500)) - 1 AS t FROM gp
      UNION ALL
      SELECT id, section, grp, c + 1, k, len(list_filter(e, lambda x: x <= e[k + 1] + 500)) - 1
      FROM (SELECT st.id, st.section, st.grp, c, gp.e,
            len(list_filter(gp.e, lambda x: x < greatest(gp.e[t + 1] - 100, gp.e[t + 2] - 500))) AS k
          FROM st JOIN gp ON st.id = gp.id AND st.section = gp.section AND st.grp = gp.grp
          WHERE t < len(gp.ps))),
    cx AS (SELECT st.id, st.section, st.grp, c, trim(array_to_string(ps[s + 1:t], ''), ' ' || chr(10)) AS chunk
      FROM st JOIN gp ON st.id = gp.id AND st.section = gp.section AND st.grp = gp.grp),
    ck AS (SELECT id, section, row_number() OVER (PARTITION BY id ORDER BY section, grp, c) - 1 AS i, chunk
      FROM cx WHERE chunk <> '')"""
DOCUMENT_CHUNKS = f"src AS (SELECT doc_id AS id, text AS md FROM documents), {CHUNKS}"
ORACLE["chunk_text"] = f"""WITH RECURSIVE {DOCUMENT_CHUNKS}
    SELECT id, i, length(chunk) AS length, md5(chunk) AS digest FROM ck"""
ORACLE["chunk_records"] = f"""WITH RECURSIVE {DOCUMENT_CHUNKS}
    SELECT 'docs/' || id || '.html_chunk_' || i AS id, '' AS original_url, '' AS scrape_time,
      0 AS headers, md5(chunk) AS chunk, 'docs/' || id || '.html' AS source_file,
      'v1' AS chunking_strategy_version FROM ck"""
ORACLE["chunk_headers"] = f"""WITH RECURSIVE src AS (SELECT doc_id AS id, {MARKDOWN} AS md FROM documents), {CHUNKS}
    SELECT 'docs/' || ck.id || '.html_chunk_' || i AS id, concat_ws(' > ', h1, h2, h3) AS headers, md5(chunk) AS digest
    FROM ck JOIN sec ON sec.id = ck.id AND sec.section = ck.section"""
ORACLE["line_offsets"] = f"""WITH RECURSIVE {DOCUMENT_CHUNKS}
    SELECT 'docs/' || id || '.html_chunk_' || i AS id, 'chunks/v1' AS chunk_gcs_uri,
      row_number() OVER (ORDER BY 'docs/' || id || '.html', i) - 1 AS chunk_line_offset FROM ck"""

ORACLE["read_jsonl_tolerant"] = """
    SELECT doc_id::VARCHAR AS id, source AS source_file, md5(text) AS digest
    FROM documents WHERE source <> 'src1' AND text <> ''"""
ORACLE["quarantined_lines"] = """
    SELECT substr('{"id":"' || doc_id || '","' || CASE WHEN lang = 'en' THEN 'chunk' ELSE 'text' END
      || '":"' || replace(text, chr(10), '\\n'), 1, 20) AS line FROM documents WHERE source = 'src1'"""
ORACLE["reuse_chunks"] = """
    SELECT doc_id::VARCHAR AS id, row_number() OVER (ORDER BY doc_id) - 1 AS chunk_line_offset
    FROM documents WHERE source <> 'src1'"""

ARTIFACTS = """
    a AS (SELECT event_type AS display_name, 'store/' || event_id AS uri, ts,
      CASE WHEN value > 10 THEN 'LIVE' ELSE 'DELETED' END AS state FROM events)"""
LATEST = """QUALIFY row_number() OVER (PARTITION BY display_name ORDER BY ts DESC, uri DESC) = 1"""
ORACLE["latest_artifact"] = f"WITH {ARTIFACTS} SELECT display_name, uri FROM a {LATEST}"
ORACLE["live_artifact"] = f"""WITH {ARTIFACTS}
    SELECT display_name, uri FROM a WHERE state = 'LIVE' {LATEST}"""
ORACLE["versioned_name"] = """
    SELECT p_partkey, p_type || '/' || p_brand AS path, 'bm25_index_' || p_brand AS model_name,
      p_type || '_index_' || p_brand || '_' || translate(p_name || '/' || p_retailprice, './', '--')
        AS index_name FROM part"""
ORACLE["list_objects"] = """
    SELECT lang, doc_id % 3 AS part, 1 AS objects, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS length FROM documents GROUP BY ALL"""

ORACLE["dedupe_last"] = """
    SELECT vec_id AS id, CASE WHEN label = 0 THEN 0 ELSE len(embedding) END AS dims,
      CASE WHEN label = 0 THEN 0.0::DOUBLE ELSE round(list_sum(embedding::DOUBLE[]), 6) END AS total,
      CASE WHEN label <> 0 THEN round(embedding[1]::DOUBLE, 6) END AS first
    FROM embeddings"""
ORACLE["merge_datapoints"] = f"""WITH {DOC_TF}, {STATS}, {WEIGHTS},
    s AS (SELECT id, count(*) AS n_terms, round(sum(weight), 4) AS weight FROM dw GROUP BY id)
    SELECT d.doc_id AS id, 0 AS restricts, 0 AS numeric_restricts, lang, source, n_chars, n_terms, weight,
      CASE WHEN vec_id IS NULL THEN -1 WHEN label = 0 THEN 0 ELSE len(embedding) END AS dims
    FROM documents d JOIN s ON s.id = d.doc_id LEFT JOIN embeddings ON vec_id = d.doc_id"""

UNITS = """
    u AS (SELECT vec_id::VARCHAR AS id, label, 'f' || label AS source_file, embedding[1] AS e1,
      round((embedding[1]::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])))
        ::FLOAT::DOUBLE, 5) AS first FROM embeddings)"""
ORACLE["index_overwrite"] = f"""WITH {UNITS}
    SELECT id, source_file, 'two' AS batch, first FROM u WHERE label < 7"""
ORACLE["index_upsert"] = f"""WITH {UNITS}
    SELECT id, source_file, CASE WHEN label >= 5 THEN 'two' ELSE 'one' END AS batch, first FROM u"""
ORACLE["rejected_rows"] = f"""WITH
    x AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'The of and' ELSE text END AS text FROM documents),
    kept AS (SELECT doc_id, text FROM x WHERE doc_id % 10 <> 0 AND text <> ''),
    {tf_of("kept", "doc_id", "tf")}
    SELECT 'broken line' AS reason, 'lines' AS source, '{{"id": "' || doc_id AS detail, 'r1' AS run FROM x WHERE doc_id % 10 = 0
    UNION ALL SELECT 'no terms', doc_id::VARCHAR, NULL, 'r1' FROM kept WHERE doc_id NOT IN (SELECT id FROM tf)
    UNION ALL SELECT 'failed text', doc_id::VARCHAR, 'length', 'r1' FROM kept WHERE length(text) % 7 = 0
    UNION ALL SELECT 'failed page', page_id::VARCHAR, 'no content', 'r1' FROM pages WHERE page_id % 7 = 0"""
ORACLE["index_compacted"] = ORACLE["index_upsert"]
ORACLE["index_replace_files"] = f"""WITH {UNITS},
    part AS (SELECT * FROM u WHERE label >= 5 AND e1 > 0)
    SELECT id, source_file, 'two' AS batch, first FROM part UNION ALL
    SELECT id, source_file, 'one' AS batch, first FROM u
    WHERE source_file NOT IN (SELECT source_file FROM part)"""
ORACLE["datapoint_lines"] = f"""
    SELECT vec_id::VARCHAR AS id, 'f' || label AS source_file, 'one' AS batch, len(embedding) AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS total,
      round(embedding[-1]::DOUBLE, 4) AS last, 0 AS restricts, vec_id AS term, 1.0::DOUBLE AS weight FROM embeddings"""

ORACLE["index_overwrite_empty"] = f"""WITH {UNITS}
    SELECT id, source_file, 'two' AS batch, first FROM u WHERE label >= 5"""
ORACLE["dedupe_null_order"] = """
    SELECT doc_id // 2 AS id, doc_id, source, CASE WHEN doc_id % 3 <> 0 THEN doc_id END AS seq FROM documents
    QUALIFY row_number() OVER (PARTITION BY doc_id // 2 ORDER BY CASE WHEN doc_id % 3 <> 0 THEN doc_id END DESC NULLS LAST) = 1"""

REPLIES = """
    n AS (SELECT user_id AS qid, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rank,
      event_type AS id, value AS distance, round(value / 2, 6) AS sparse_distance,
      CASE WHEN event_type <> 'error' THEN 'chunks/v1' END AS chunk_gcs_uri,
      event_id AS chunk_line_offset FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 10)"""
FETCHED = f"""{REPLIES},
    f AS (SELECT qid, rank, n.id, text FROM n JOIN documents ON doc_id = chunk_line_offset
      WHERE chunk_gcs_uri IS NOT NULL AND lang <> 'de' AND text <> '')"""
ORACLE["parse_neighbors"] = f"WITH {REPLIES} SELECT * FROM n"
ORACLE["fetch_chunks"] = f"WITH {FETCHED} SELECT qid, rank, id, md5(text) AS digest FROM f"
ORACLE["build_context"] = f"""WITH {FETCHED},
    i AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS i FROM f),
    c AS (SELECT qid, {quoted(PROMPT_HEAD)} || string_agg('Context ' || i || ': ' || text, chr(10) ORDER BY i)
        || {quoted(PROMPT_QUESTION)} || 'question ' || qid || {quoted(PROMPT_TAIL)} AS p
      FROM i GROUP BY qid)
    SELECT qid, md5(p) AS digest, length(p) AS length FROM c"""


# Markdown of the test pages by substitution: they hold few kinds of tags, no nested lists, and bold
# tags that stay open to the end of their article; <bb> marks where those close.
NEWLINE = "' || chr(10) || '"
TAG_STEPS = (
    (r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->|<!DOCTYPE[^>]*>", ""),
    (r"([*_])", r"\\\1"),
    (r"[ \t\r\n\f]+", " "),
    (r"</li>", "\n"),
    (r"<li>", "* "),
    (r"<h1>", "\n\n# "),
    (r"\s*</h1>", "\n\n"),
    (r"<b>", "**"),
    (r"<br>", "  \n"),
    (r"</?a\b[^>]*>|<meta[^>]*>", ""),
    (r"</?(?:[ac-z]|b[a-z]{2,}|h1)[^>]*>", "\n\n"),
    (r"(\s*)((?:<bb>)+)", r"\2\1"),
    (r"<bb>", "**"),
    (r"&copy;", "©"),
    (r"&middot;", "·"),
    (r"&quot;", '"'),
    (r"&amp;?", "&"),
    (r"\n{3,}", "\n\n"),
)


def markdown(source: str) -> str:
    """CTE ``md(key, md)`` over ``source(key, html)``."""
    opened = "(length(html) - length(replace(html, '<b>', ''))) // 3"
    text = f"replace(html, '</article>', repeat('<bb>', {opened}) || '</article>')"
    for pattern, by in TAG_STEPS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(by).replace(chr(10), NEWLINE)}, 'g')"
    return f"md AS (SELECT key, trim({text}, ' ' || chr(10)) AS md FROM {source})"


ORACLE["clean_pages"] = f"""WITH src AS (SELECT page_id AS key, html FROM pages), {markdown("src")}
    SELECT key AS page_id, md AS markdown, NULL AS error FROM md"""

# Whole flows: stored pages to chunks, terms and datapoints.
CORPUS = f"""{KEYED},
    pg AS (SELECT source_file AS key, html, url LIKE '%.net%' AS later FROM k
      QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY page_id DESC) = 1),
    {markdown("pg")}, src AS (SELECT key AS id, md FROM md), {CHUNKS},
    ids AS (SELECT ck.id AS source_file, ck.id || '_chunk_' || i AS key, i, chunk AS text FROM ck),
    corpus AS (SELECT * FROM ids)"""
POINTS = f"""WITH RECURSIVE {CORPUS}, {CORPUS_TF},
    t AS (SELECT id, count(*) AS n_terms FROM tf GROUP BY id)"""
ORACLE["full_rebuild"] = f"""{POINTS},
    o AS (SELECT key, row_number() OVER (ORDER BY source_file, i) - 1 AS line FROM corpus)
    SELECT key AS id, n_terms, 256 AS dims, line FROM o JOIN t ON t.id = key"""
ORACLE["incremental_update"] = f"""{POINTS},
    o AS (SELECT corpus.key, row_number() OVER (PARTITION BY later ORDER BY source_file, i) - 1 AS line
      FROM corpus JOIN pg ON pg.key = source_file)
    SELECT key AS id, n_terms, 256 AS dims, line FROM o JOIN t ON t.id = key"""
ORACLE["update_without_chunks"] = ORACLE["incremental_update"]
ORACLE["streaming_update"] = ORACLE["incremental_update"]
INDEXED = "SELECT DISTINCT id FROM tf"
ORACLE["answer_after_update"] = "SELECT item_id AS qid, 10 AS contexts FROM benchmark"
ORACLE["intake_pages"] = f"""WITH {KEYED},
    one AS (SELECT source_file, page_id, html FROM k
      QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY page_id DESC) = 1)
    SELECT source_file, CASE WHEN page_id % 2 = 0 THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS scrape_time,
      md5(CASE WHEN page_id % 2 = 0 THEN html ELSE '<p>new</p>' END) AS digest FROM one"""
ORACLE["answer_queries"] = f"""WITH RECURSIVE {CORPUS}, {CORPUS_TF}, {fused(INDEXED, 10, "unit")},
    got AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY rank) AS i, corpus.text AS chunk
      FROM fr JOIN corpus ON corpus.key = fr.id WHERE rank <= 10),
    ctx AS (SELECT qid, string_agg('Context ' || i || ': ' || chunk, chr(10) ORDER BY i) AS context
      FROM got GROUP BY qid)
    SELECT qid, {quoted(PROMPT_HEAD)} || context || {quoted(PROMPT_QUESTION)} || text
      || {quoted(PROMPT_TAIL)} AS prompt FROM ctx JOIN benchmark ON item_id = qid"""

PER_DOCUMENT = f"""WITH {DOC_TF}, t AS (SELECT id, count(*) AS n_terms FROM tf GROUP BY id)"""
ORACLE["ingest_chunks"] = f"""{PER_DOCUMENT}
    SELECT id::VARCHAR AS id, n_terms, 256 AS dims, id AS line FROM t"""
ORACLE["streaming_chunks"] = ORACLE["ingest_chunks"]
ORACLE["ingest_without_offsets"] = f"""{PER_DOCUMENT}
    SELECT id::VARCHAR AS id, n_terms, 256 AS dims FROM t"""
ORACLE["merged_datapoints"] = f"""{PER_DOCUMENT},
    d AS (SELECT doc_id AS line, doc_id // 2 AS id, max(doc_id) OVER (PARTITION BY doc_id // 2) AS last
      FROM documents WHERE text <> '')
    SELECT d.id::VARCHAR AS id, n_terms, 256 AS dims, line FROM d JOIN t ON t.id = last"""
ORACLE["scan_pages"] = "SELECT page_id, md5(html || chr(10)) AS digest, '' AS original_url FROM pages"
ORACLE["answer_by_postings"] = ORACLE["answer_queries"]


def _letters(letters: str) -> str:
    return " || ',' || ".join(f"(length(text) - length(replace(text, '{x}', '')))" for x in letters)


ORACLE["role_embed"] = f"""SELECT 'document' AS role, doc_id AS id, {_letters("aeiou")} AS counts FROM documents
    UNION ALL SELECT 'query', item_id, {_letters("nrst")} FROM benchmark"""
ORACLE["chunk_scanned"] = f"""WITH RECURSIVE pg AS (SELECT page_id AS key, html FROM pages), {markdown("pg")},
    src AS (SELECT key AS id, md FROM md), {CHUNKS}
    SELECT id AS page_id, i, md5(chunk) AS digest, '' AS original_url FROM ck"""
