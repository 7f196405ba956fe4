"""DuckDB SQL of the operators' queries that SQL can express, over the same tables."""

LLM_ORACLES: dict[str, str] = {
    "op4_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS shingles
            FROM d
        ), c AS (
            SELECT doc_id, len(shingles) AS n, min(doc_id) OVER (PARTITION BY list_sort(shingles)) AS cls, shingles FROM s
        ), t AS (
            SELECT cls, n, unnest(shingles) AS shingle FROM c WHERE doc_id = cls
        ), links AS (
            SELECT a.cls AS a, b.cls AS b FROM t a JOIN t b ON a.shingle = b.shingle AND a.cls <> b.cls AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
            GROUP BY a.cls, b.cls HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reach(a, b) AS (
            SELECT cls, cls FROM c WHERE doc_id = cls
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a WHERE reach.a < links.b
        ), label AS (
            SELECT b AS cls, min(a) AS component_id FROM reach GROUP BY b
        )
        SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id FROM c JOIN label USING (cls)
    """,
    "op5_fm_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' '))) AS windows FROM d
        ), p AS (
            SELECT doc_id, unnest(windows) AS win, generate_subscripts(windows, 1) AS pos FROM s
        ), h AS (
            SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM p
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM h WHERE again
        ), l AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
        ), k AS (
            SELECT l.doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS kept
            FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op7_suffix_dedup": r"""
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
        ), s AS (
            SELECT doc_id, list_transform(range(1, n_bytes - 98), lambda i: md5(substr(h, 2 * i - 1, 200))) AS strings FROM d
        ), p AS (
            SELECT doc_id, unnest(strings) AS string, generate_subscripts(strings, 1) AS pos FROM s
        ), again AS (
            SELECT doc_id, pos FROM p QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, pos) > 1
        ), runs AS (
            SELECT doc_id, pos, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100, true) AS fresh FROM again
        ), spans AS (
            SELECT doc_id, min(pos) AS first, max(pos) + 100 AS past
            FROM (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM runs) GROUP BY doc_id, span
        ), cuts AS (
            SELECT doc_id, list(first ORDER BY first) AS firsts, list(past ORDER BY first) AS pasts FROM spans GROUP BY doc_id
        ), k AS (
            SELECT d.doc_id, n_bytes, coalesce(len(firsts), 0) AS n_spans, [1] || coalesce(pasts, []) AS b, coalesce(firsts, []) || [n_bytes + 1] AS e, h
            FROM d LEFT JOIN cuts ON d.doc_id = cuts.doc_id
        ), r AS (
            SELECT *, array_to_string(list_transform(range(1, n_spans + 2), lambda i: substr(h, 2 * b[i] - 1, 2 * (e[i] - b[i]))), '') AS kept FROM k
        )
        SELECT doc_id, n_bytes, n_bytes - strlen(kept) // 2 AS n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM r
    """,
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(length(text), 0) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), w AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
    """,
    "op10_line_dedup": r"""
        WITH d AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
        ), k AS (
            SELECT doc_id, pos, line,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), often AS (
            SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), f AS (
            SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON k.key = often.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id
    """,
}
