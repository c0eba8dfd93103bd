"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: Vectors that take part, as doubles.
VECTORS = """
rows AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
)"""

OP5_NEIGHBOURS = f"""
WITH {VECTORS},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM (SELECT DISTINCT vec_id, v FROM rows WHERE vec_id % 20 = 0) q
  JOIN rows c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

#: Links between all vectors, and the smallest id that each reaches.
OP9_VECTOR_DEDUP = f"""
WITH RECURSIVE {VECTORS},
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v)) >= 0.95
),
reached AS (
  SELECT vec_id AS id, vec_id AS least FROM embeddings
  UNION
  SELECT l.a, r.least FROM reached r JOIN links l ON l.b = r.id WHERE r.least < l.a
),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(any_value(c.n), 0)::BIGINT AS n_links, min(r.least) AS component_id, min(r.least) = e.vec_id AS kept
FROM embeddings e JOIN reached r ON r.id = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
GROUP BY e.vec_id
"""



def _lloyd(rounds: int = 10) -> str:
    """A CTE for each round: a for assignments, c for centroids."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, cluster, d FROM (
    SELECT r, cluster, d, row_number() OVER (PARTITION BY r ORDER BY d, cluster) AS n FROM (
      SELECT w.r, c.cluster, sum((w.x - c.x) * (w.x - c.x)) AS d FROM wide w JOIN c{i} c ON c.k = w.k GROUP BY w.r, c.cluster))
  WHERE n = 1
)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.k, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT a.cluster, w.k, sum(w.x) AS s, count(*) AS n FROM a{i} a JOIN wide w ON w.r = a.r GROUP BY a.cluster, w.k) m
  ON m.cluster = c.cluster AND m.k = c.k
)""")
    return ",".join(steps)


OP12_CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, embedding AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
wide AS MATERIALIZED (SELECT r, k, floor(1024 * v[k + 1]::DOUBLE)::BIGINT AS x FROM kept CROSS JOIN range(0, 64) g(k)),
c0 AS MATERIALIZED (
  SELECT f.cluster, w.k, w.x FROM wide w JOIN (
    SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS cluster FROM kept ORDER BY cluster LIMIT 8) f ON f.r = w.r
),{_lloyd()},
marks AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY k)) AS mark FROM c10 GROUP BY cluster)
SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, m.mark AS centroid_sha256
FROM a10 a JOIN kept k ON k.r = a.r JOIN marks m ON m.cluster = a.cluster
"""

#: Every pair of sources of a language over every kept term, without grouping of equal counts.
OP13_DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM docs
),
seen AS MATERIALIZED (
  SELECT d, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS n FROM words GROUP BY ALL
),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM seen GROUP BY lang, term HAVING count(*) >= 3),
counts AS (SELECT s.lang, s.source, s.term, sum(s.n) AS n FROM seen s JOIN kept k ON k.lang = s.lang AND k.term = s.term GROUP BY ALL),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
sources AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l USING (lang)
),
shares AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + s.v)) AS p
  FROM sources s JOIN kept k ON k.lang = s.lang LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM shares x JOIN shares y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL) f
  ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM (
    SELECT x.lang, x.source, x.term, x.n, x.p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
    FROM shares x JOIN kept k ON k.lang = x.lang AND k.term = x.term JOIN langs l ON l.lang = x.lang)
  WHERE n > 0 AND p > q
),
ranked AS (
  SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

SQL = {"op5_neighbours": OP5_NEIGHBOURS, "op9_vector_dedup": OP9_VECTOR_DEDUP, "op12_centroids": OP12_CENTROIDS, "op13_divergence": OP13_DIVERGENCE}
