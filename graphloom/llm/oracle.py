"""DuckDB SQL of the training-data queries, written apart from the Spark code."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
level AS (
  SELECT 0 AS step, 0.0::DOUBLE AS v
  UNION ALL
  SELECT l.step + 1,
         (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE - sum(CASE WHEN w * l.v > cap THEN cap ELSE 0.0::DOUBLE END))
                 / sum(CASE WHEN w * l.v > cap THEN 0 ELSE w END)::DOUBLE FROM s)
  FROM level l WHERE l.step < 40),
t AS (
  SELECT source, source_size, least(cap, w * (SELECT max(v) FROM level)) AS target FROM s),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
u AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS unit
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest THEN 1
                             WHEN upto - unit <= rest AND 2 * (rest - (upto - unit)) > unit THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u
"""

ORACLE["op10_minhash_near"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT r, list_aggregate(ws[i:i + 3], 'string_agg', ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
sig AS (SELECT r, md5(string_agg(s, '|' ORDER BY s)) AS g FROM sh GROUP BY r),
g AS (SELECT g, min(r) AS r FROM sig GROUP BY g),
rep AS (SELECT sh.r, s, n FROM sh JOIN g USING (r) JOIN n USING (r)),
inter AS (
  SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM rep a JOIN rep b ON a.s = b.s AND a.r <> b.r AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM inter WHERE 100 * shared >= 80 * (na + nb - shared)),
reach AS (
  SELECT r AS a, r AS b FROM g
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
own AS (SELECT sig.r, reach.b FROM sig JOIN g USING (g) JOIN reach ON reach.a = g.r),
members AS (SELECT g.r AS b, min(w.doc_id) AS least FROM sig JOIN g USING (g) JOIN w ON w.r = sig.r GROUP BY g.r),
comp AS (SELECT own.r, min(least) AS component_id FROM own JOIN members USING (b) GROUP BY own.r)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS kept
FROM w LEFT JOIN n USING (r) LEFT JOIN comp USING (r)
"""

ORACLE["op3_secret_ledger"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT r, 'assign' AS kind, 1 AS ord, 12 AS least,
         string_split_regex(text, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS gaps,
         regexp_extract_all(text, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS found,
         regexp_extract_all(text, '((?i)password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS held
  FROM d
  UNION ALL
  SELECT r, 'access', 2, 18, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL
  SELECT r, 'hex', 3, 16, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+') FROM d
  UNION ALL
  SELECT r, 'pem', 4, 1, string_split_regex(text, '-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----'),
         regexp_extract_all(text, '-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----'), regexp_extract_all(text, '-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----') FROM d
  UNION ALL
  SELECT r, 'jwt', 5, 1, string_split_regex(text, 'eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}'),
         regexp_extract_all(text, 'eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}'),
         regexp_extract_all(text, 'eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}') FROM d),
e AS (
  SELECT r, kind, ord, least, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS f, unnest(held) AS h,
         unnest(gaps[1:len(found)]) AS g
  FROM m WHERE len(found) > 0),
s AS (
  SELECT r, kind, ord, least, f, h, sum(length(g) + length(f)) OVER (PARTITION BY r, ord ORDER BY i) AS stop FROM e),
x AS (SELECT r, kind, ord, stop - length(f) AS start, stop FROM s WHERE length(h) >= least),
g AS (
  SELECT r, count(*) FILTER (ord = 1) AS n_assign, count(*) FILTER (ord = 2) AS n_access, count(*) FILTER (ord = 3) AS n_hex,
         sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord <= 3), '')) AS base_sha256,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""

ORACLE["op8_pivot_top_k"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, c.r,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM o WHERE rank <= 5
"""

ORACLE["op11_segment_negatives"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) AS place FROM p WHERE same) WHERE place <= 5),
neg AS (
  SELECT pos.anchor_id, pos.vec_id AS positive_id, pos.score AS positive_score, p.vec_id AS negative_id, p.score AS negative_score,
         row_number() OVER (PARTITION BY pos.ar, pos.r ORDER BY p.score DESC, p.vec_id, p.r) AS rank
  FROM pos JOIN p ON p.ar = pos.ar AND NOT p.same AND 30 * pos.score <= 100 * p.score AND 100 * p.score <= 90 * pos.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""

ORACLE["op12_count_tree_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT r, list_aggregate(ws[i:i + 3], 'string_agg', ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
sig AS (SELECT r, md5(string_agg(s, '|' ORDER BY s)) AS g FROM sh GROUP BY r),
g AS (SELECT g, min(r) AS r FROM sig GROUP BY g),
rep AS (SELECT sh.r, s, n FROM sh JOIN g USING (r) JOIN n USING (r)),
inter AS (
  SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM rep a JOIN rep b ON a.s = b.s AND a.r <> b.r AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM inter WHERE 100 * shared >= 85 * (na + nb - shared)),
reach AS (
  SELECT r AS a, r AS b FROM g
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
own AS (SELECT sig.r, reach.b FROM sig JOIN g USING (g) JOIN reach ON reach.a = g.r),
members AS (SELECT g.r AS b, min(w.doc_id) AS least FROM sig JOIN g USING (g) JOIN w ON w.r = sig.r GROUP BY g.r),
comp AS (SELECT own.r, min(least) AS component_id FROM own JOIN members USING (b) GROUP BY own.r)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM w LEFT JOIN n USING (r) LEFT JOIN comp USING (r)
"""

ORACLE["op13_run_diagonals"] = r"""
WITH c AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda h, b: list_reduce(list_prepend(xor(h, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS h0
  FROM documents),
b AS (SELECT d, doc_id, ws, len(ws)::BIGINT AS n, xor(h0, 4294967295) AS h FROM c),
k AS (
  SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM b),
t AS (
  SELECT d, doc_id, n, CASE WHEN n > 0 AND h % 10 = 0
           THEN list_transform(range(0, n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws
  FROM k),
w AS (SELECT d, unnest(range(0, n)) AS i, unnest(ws) AS word FROM t),
gram AS (SELECT d, n, i, array_to_string(ws[i + 1:i + 5], ' ') AS g FROM (SELECT d, n, ws, unnest(range(0, n - 4)) AS i FROM t WHERE n > 5)),
seed AS (SELECT x.d, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.d = y.d AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS isle FROM seed),
long AS (
  SELECT d, q, min(i) AS start, max(i) + 5 + q AS stop FROM island GROUP BY d, q, isle
  HAVING max(i) + 5 + q - min(i) >= greatest(6, 4 * q)),
run AS (
  SELECT d, q AS period, start, stop - start AS length FROM long x
  WHERE NOT EXISTS (SELECT 1 FROM long y WHERE y.d = x.d AND y.q < x.q AND y.start <= x.start AND y.stop >= x.stop)),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM run) WHERE place = 1),
lines AS (
  SELECT d, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS digest FROM run GROUP BY d),
dropped AS (SELECT DISTINCT d, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT d, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN dropped USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       coalesce(digest, sha256('')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN lines USING (d) LEFT JOIN best USING (d) LEFT JOIN kept USING (d)
"""
