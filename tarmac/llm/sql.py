"""DuckDB SQL for the text queries that SQL can express; the others have brute-force tests."""

SQL: dict[str, str] = {
    # Windows of two non-blank lines, and single lines of 50 words, whose first place is elsewhere go.
    "op2_lines": """
WITH raw AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS j FROM raw
),
filled AS (
  SELECT doc_id, j, line,
         row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i,
         lead(line) OVER (PARTITION BY doc_id ORDER BY j) AS line2
  FROM numbered WHERE trim(line) <> ''
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, i) AS place
  FROM filled WHERE line2 IS NOT NULL
),
long AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS place
  FROM filled WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 50
),
covered AS (
  SELECT doc_id, i FROM placed WHERE place > 1
  UNION
  SELECT doc_id, i + 1 FROM placed WHERE place > 1
  UNION
  SELECT doc_id, i FROM long WHERE place > 1
),
gone AS (
  SELECT f.doc_id, f.j FROM filled f JOIN covered USING (doc_id, i)
),
islands AS (
  SELECT doc_id, j, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS island FROM gone
),
longest AS (
  SELECT doc_id, max(n) AS longest_run, sum(n) AS n_removed
  FROM (SELECT doc_id, island, count(*) AS n FROM islands GROUP BY doc_id, island)
  GROUP BY doc_id
),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.j) AS text
  FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.j = g.j
  GROUP BY n.doc_id
)
SELECT r.doc_id,
       CAST(len(r.lines) AS BIGINT) AS n_lines,
       CAST(coalesce(l.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(l.longest_run, 0) AS BIGINT) AS longest_run,
       CASE WHEN r.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM raw r LEFT JOIN longest l USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    # All pairs that share a shingle, and the smallest id reachable by links.
    "op3_jaccard": """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(
           CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           END) AS s
  FROM worded
),
spread AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM spread a JOIN spread b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
FROM sets s LEFT JOIN lowest l ON s.doc_id = l.a
""",
    "op4_topk": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op7_decontaminate": """
WITH worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM sized
),
lengths AS (SELECT DISTINCT n FROM windows),
placed AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM worded, lengths WHERE len(w) >= n
),
found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM placed p JOIN windows x ON p.n = x.n AND p.g = x.g),
words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(x.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(x.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM worded d LEFT JOIN words h USING (doc_id) LEFT JOIN ids x USING (doc_id)
""",
    # Every string of 200 bytes, as hexadecimal digits cut from pieces of 1,000 bytes and 199 more.
    "op10_suffix": """
WITH whole AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
),
pieces AS (
  SELECT r, p, substring(h, 2 * p + 1, 2398) AS h
  FROM (SELECT r, h, unnest(range(0, greatest(length(h) // 2 - 199, 0), 1000)) AS p FROM whole)
),
places AS (
  SELECT r, p + i AS i, md5(substring(h, 2 * i + 1, 400)) AS g
  FROM (SELECT r, p, h, unnest(range(0, least(1000, length(h) // 2 - 199))) AS i FROM pieces)
),
again AS (SELECT g FROM places GROUP BY g HAVING count(*) > 1),
starts AS (SELECT r, i FROM places WHERE g IN (SELECT g FROM again)),
numbered AS (
  SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS island
  FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens
        FROM starts)
),
spans AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, island),
cut AS (
  SELECT w.r, s.a, s.b, substring(w.h, 2 * prev + 1, 2 * (s.a - prev)) AS kept
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS prev FROM spans) s
  JOIN whole w ON s.r = w.r
),
summed AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(kept, '' ORDER BY a) AS kept
  FROM cut GROUP BY r
)
SELECT w.doc_id, CAST(length(w.h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(s.kept, '') || substring(w.h, 2 * coalesce(s.last, 0) + 1))) AS kept_sha256
FROM whole w LEFT JOIN summed s ON w.r = s.r
""",
    # Every document that shares a term with an item is scored.
    "op11_ranked": """
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
),
size AS (
  SELECT count(*) FILTER (WHERE len(w) > 0) AS n_all, CAST(coalesce(sum(len(w)), 0) AS BIGINT) AS l_all FROM worded
),
spread AS (SELECT row, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM worded),
tfs AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM spread WHERE term IN (SELECT term FROM items) GROUP BY row, doc_id, n, term
),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
impacts AS (
  SELECT row, doc_id, t.term,
         CAST(floor(1000 * ln((2 * n_all + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_all) // l_all)))) AS impact
  FROM tfs t JOIN dfs USING (term), size
),
scored AS (
  SELECT item_id, row, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM items JOIN impacts USING (term) GROUP BY item_id, row, doc_id HAVING sum(impact) > 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    # Units listed one by one; forms and cuts from the hash of seed and id.
    "op12_middle": """
WITH parted AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT *, len(u) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm'
              ELSE 'psm' END AS form
  FROM parted
),
cut AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
""",
}
