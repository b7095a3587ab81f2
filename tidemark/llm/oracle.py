"""SQL twins of the operators that SQL can express, for DuckDB on the same tables."""

from .decontaminate import ORACLE as DECONTAMINATE

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS g FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
 e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

LINES = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d),
 f AS (SELECT line, min((doc_id, p)) AS id, length(line) AS n FROM l WHERE length(line) >= 20 OR regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY line),
 q AS (SELECT line, id, n + unnest([-2, -1, 0, 1, 2]) AS m FROM f WHERE n >= 20),
 gone AS (SELECT DISTINCT q.line FROM q JOIN f ON f.n = q.m AND f.n >= 20 AND f.id < q.id WHERE levenshtein(q.line, f.line) <= 2),
 k AS (SELECT l.doc_id, l.p, l.line FROM l LEFT JOIN f ON f.line = l.line LEFT JOIN gone ON gone.line = l.line WHERE f.line IS NULL OR (gone.line IS NULL AND f.id = (l.doc_id, l.p)))
SELECT d.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(ls), 0) - count(k.p) AS n_removed, sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.p), '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id, d.ls
"""

ORACLE = {"op4_decontaminate": DECONTAMINATE, "op6_jaccard": JACCARD, "op9_lines": LINES}
