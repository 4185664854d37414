"""DuckDB SQL with the results of the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

#: Blocks of 512 words in md5 order; a source's broken pass takes the leading words.
MIXING = rf"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
named AS (
  SELECT *, (source_size * 2)::DOUBLE AS cap, list_extract([5.0, 2.0, 1.0]::DOUBLE[],
    ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)) AS w,
    row_number() OVER (ORDER BY encode(source) NULLS LAST) AS idx,
    sum(source_size) OVER ()::DOUBLE * 1.5 AS goal
  FROM per),
stops AS (
  SELECT *, (goal - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w
    >= cap * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stopped
  FROM named WINDOW o AS (ORDER BY cap / w, idx)),
targets AS (
  SELECT *, CASE WHEN stopped THEN cap ELSE least((goal - coalesce(sum(CASE WHEN stopped THEN cap END)
    OVER (), 0)) * w / sum(CASE WHEN NOT stopped THEN w END) OVER (), cap) END AS target FROM stops),
goals AS (
  SELECT source, source_size, target, floor(target + 0.5)::BIGINT AS words,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes
  FROM targets),
units AS (SELECT doc_id, source, size, count(*) AS copies FROM sizes GROUP BY ALL),
blocks AS (
  SELECT doc_id, source, size, copies, block, least(512, size - block * 512) AS words,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '\N') || '|' || coalesce(source, '\N')
      || '|' || size || '|' || block), 1, 15))::BIGINT AS h
  FROM (SELECT *, unnest(range((size + 511) // 512)) AS block FROM units)),
ranked AS (
  SELECT *, coalesce(sum(words * copies) OVER (PARTITION BY source ORDER BY h, doc_id, size, block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM blocks),
taken AS (
  SELECT r.doc_id, r.source, r.size, sum(g.passes * r.words
    + greatest(0, least(g.words - g.passes * g.source_size - seen, r.words * copies)) // copies) AS taken
  FROM ranked r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source GROUP BY ALL)
SELECT s.doc_id, s.size, g.source_size, g.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
LEFT JOIN taken t ON s.doc_id IS NOT DISTINCT FROM t.doc_id
  AND s.source IS NOT DISTINCT FROM t.source AND s.size = t.size
"""

LINE_DEDUP = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT r, doc_id, string_split(text, chr(10)) AS ls FROM docs),
lines AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM parts),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
bad AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
flagged AS (SELECT k.*, b.key IS NOT NULL AS gone FROM keyed k LEFT JOIN bad b ON k.key = b.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY r, doc_id
"""

#: Every 50th vector against all others (blocks of a stated query set).
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: Every order of the filters met by every mask, by comparing the order's letters.
FILTER_AUDIT = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM docs GROUP BY t),
said AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
  SELECT part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(d.t, '[A-Z]')) > 5 * len(d.t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > f.first_id THEN 'E' ELSE '' END AS fails,
    coalesce(s.good, false) AS good, coalesce(s.toxic, false) AS toxic
  FROM docs d JOIN firsts f ON d.t = f.t LEFT JOIN said s ON d.doc_id = s.doc_id),
counted AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a JOIN letters b ON b.c <> a.c JOIN letters c ON c.c NOT IN (a.c, b.c)
  JOIN letters d ON d.c NOT IN (a.c, b.c, c.c) JOIN letters e ON e.c NOT IN (a.c, b.c, c.c, d.c)),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
found AS (
  SELECT part, filter_order, step, filter_order[step] AS f, n, good, toxic, fails,
    contains(fails, filter_order[step]) AS hit,
    len(regexp_extract_all(filter_order[1:step - 1], '[' || fails || '_]')) > 0 AS before
  FROM steps, counted),
summed AS (
  SELECT part, filter_order, step, any_value(f) AS f,
    coalesce(sum(n) FILTER (NOT before AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT before AND hit), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (before AND hit), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT before AND hit), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT before AND hit), 0)::BIGINT AS toxic_lost
  FROM found GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed
"""

#: Exact similarity of all sets that share a shingle, and closure of the links.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS s FROM docs),
classes AS (SELECT min(r) AS c, s, min(doc_id) AS low FROM sets WHERE len(s) > 0 GROUP BY s),
posted AS (SELECT c, len(s) AS n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.c AS u, b.c AS v FROM posted a JOIN posted b ON a.x = b.x AND a.c <> b.c
  GROUP BY a.c, b.c HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT c AS u, c AS v FROM classes UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
lowest AS (SELECT u, min(low) AS component_id FROM reach JOIN classes ON v = c GROUP BY u),
found AS (
  SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
    CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE l.component_id END AS component_id
  FROM sets s LEFT JOIN classes c ON s.s = c.s LEFT JOIN lowest l ON l.u = c.c)
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM found
"""
