"""DuckDB SQL for the registered queries that SQL can express, over whole tables."""

from __future__ import annotations

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Two documents meet on a shingle of five words; the smallest id within reach names a component.
SHINGLE_COMPONENTS = rf"""WITH RECURSIVE
cut AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
),
pieces AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[k : k + 4] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM cut WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM pieces GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c
  FROM pieces a JOIN pieces b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, CAST(COALESCE(s.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x) m ON m.x = d.doc_id"""

VECTOR_COMPONENTS = """WITH RECURSIVE
good AS (
  SELECT vec_id, label, embedding, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS sq
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
dots AS (
  SELECT a.vec_id AS x, b.vec_id AS y, a.sq AS p, b.sq AS q,
    list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dot
  FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.embedding) = len(b.embedding)
  WHERE a.sq > 0 AND b.sq > 0
),
links AS (SELECT x, y FROM dots WHERE dot / (sqrt(p) * sqrt(q)) >= 0.98),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT e.vec_id, CAST(COALESCE(k.n, 0) AS BIGINT) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT x, COUNT(*) AS n FROM links GROUP BY x) k ON k.x = e.vec_id
JOIN (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x) m ON m.x = e.vec_id"""

BENCHMARK_WINDOWS = rf"""WITH
cut AS (
  SELECT doc_id, COALESCE(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item, w[k : k + 9] AS f
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)
),
places AS (SELECT doc_id, w, k, w[k] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM cut)),
found AS (
  SELECT p.doc_id, p.k, v.item, len(v.f) AS n FROM places p JOIN windows v ON v.f[1] = p.word AND p.w[p.k : p.k + len(v.f) - 1] = v.f
),
hit AS (SELECT doc_id, COUNT(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM found) GROUP BY doc_id),
seen AS (
  SELECT doc_id, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT c.doc_id, CAST(len(c.w) AS BIGINT) AS n_words, CAST(COALESCE(h.n, 0) AS BIGINT) AS n_hit, CAST(COALESCE(s.n, 0) AS BIGINT) AS n_items,
  sha256(COALESCE(s.list, '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated
FROM cut c LEFT JOIN hit h ON h.doc_id = c.doc_id LEFT JOIN seen s ON s.doc_id = c.doc_id"""

COLLOCATIONS = rf"""WITH
pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counts AS (
  SELECT lang, w[k : k + m - 1] AS p, COUNT(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM cut, (VALUES (1), (2), (3)) sizes(m))
  GROUP BY 1, 2
),
words AS (SELECT lang, SUM(f) AS n FROM counts WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT lang, p, f AS a FROM counts WHERE len(p) > 1 AND f >= 10),
covered AS (
  SELECT s.lang, s.p FROM candidates s JOIN candidates t ON t.lang = s.lang AND len(s.p) = 2 AND len(t.p) = 3
    AND (t.p[1:2] = s.p OR t.p[2:3] = s.p) AND 100 * t.a >= 50 * s.a
),
cuts AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r,
    (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates ANTI JOIN covered USING (lang, p)) c
  JOIN counts x ON x.lang = c.lang AND x.p = c.p[1 : c.k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[c.k + 1 :]
),
lowest AS (SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
placed AS (
  SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM lowest
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM placed JOIN words USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": SHINGLE_COMPONENTS,
    "op7_embedding_dedup": VECTOR_COMPONENTS,
    "op9_decontamination": BENCHMARK_WINDOWS,
    "op13_collocations": COLLOCATIONS,
}
