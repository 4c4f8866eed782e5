"""DuckDB SQL for the corpus queries that SQL can express.

Hashes, checksums, vocabularies, learned scores and searches of the other
queries have no SQL equivalent; those are tested against brute force instead.
"""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def collocations_sql(least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000) -> str:
    lower = LOWER.format("coalesce(text, '')")
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (
  SELECT lang, w[i : i + s - 1] AS p, s
  FROM places, (SELECT unnest(range(1, {longest + 1})) AS s) WHERE i + s - 1 <= len(w)),
f AS (SELECT lang, p, s, count(*) AS c FROM grams GROUP BY lang, p, s HAVING count(*) >= {least}),
around AS (
  SELECT lang, p, max(c) AS most FROM (
    SELECT lang, p[1 : s - 1] AS p, c FROM f WHERE s > 2
    UNION ALL SELECT lang, p[2 : s] AS p, c FROM f WHERE s > 2) GROUP BY lang, p),
kept AS (
  SELECT f.lang, f.p, f.s, f.c AS a FROM f LEFT JOIN around ON f.lang = around.lang AND f.p = around.p
  WHERE f.s > 1 AND (around.most IS NULL OR 100 * around.most < {percent} * f.c)),
cuts AS (
  SELECT kept.lang, kept.p, kept.a, k, x.c AS l, y.c AS r, n,
         CAST(1000 * CAST(a AS HUGEINT) * CAST(n AS HUGEINT)
              // (CAST(x.c AS HUGEINT) * CAST(y.c AS HUGEINT)) AS BIGINT) AS score
  FROM kept JOIN (SELECT unnest(range(1, {longest})) AS k) ON k < kept.s
  JOIN f AS x ON x.lang = kept.lang AND x.p = kept.p[1 : k]
  JOIN f AS y ON y.lang = kept.lang AND y.p = kept.p[k + 1 : kept.s]
  JOIN totals ON totals.lang = kept.lang),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS choice FROM cuts),
named AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best WHERE choice = 1),
placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM named)
SELECT * FROM placed WHERE rank <= {top}"""


def ngram_join_sql(k: int = 3, percent: int = 90) -> str:
    lower = LOWER.format("coalesce(text, '')")
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[][]) WHEN len(w) < {k} THEN [w] ELSE
    list_distinct([w[i : i + {k - 1}] FOR i IN range(1, len(w) - {k - 2})]) END AS s
  FROM words),
elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM elements AS x JOIN elements AS y ON x.e = y.e AND x.doc_id <> y.doc_id
    AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
reach AS (
  SELECT a AS node, a AS other FROM links
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
least_of AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       coalesce(least(component_id, sets.doc_id), sets.doc_id) AS component_id
FROM sets LEFT JOIN least_of ON node = sets.doc_id"""


def centroid_clusters_sql(k: int = 8, rounds: int = 10, seed: int = 3, size: int = 64,
                          scale: int = 1024) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (
  SELECT v.id, c{r}.cluster, CAST(sum((v.x - c{r}.x) * (v.x - c{r}.x)) AS BIGINT) AS distance
  FROM v JOIN c{r} ON v.i = c{r}.i GROUP BY v.id, c{r}.cluster),
a{r} AS MATERIALIZED (
  SELECT id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM d{r} GROUP BY id)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.cluster, c{r}.i, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT a{r}.cluster, v.i, CAST(floor_of(sum(v.x), count(*)) AS BIGINT) AS x
    FROM a{r} JOIN v ON v.id = a{r}.id GROUP BY a{r}.cluster, v.i) AS m
  ON m.cluster = c{r}.cluster AND m.i = c{r}.i)""")
    # // rounds towards zero: take one off where a remainder of the other sign is left
    floor_of = "(sum(v.x) // count(*) - CASE WHEN sum(v.x) % count(*) < 0 THEN 1 ELSE 0 END)"
    body = ",".join(steps).replace("floor_of(sum(v.x), count(*))", floor_of)
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {size}
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {size}),
v AS MATERIALIZED (
  SELECT id, CAST(floor({scale} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x, i
  FROM kept, (SELECT unnest(range(1, {size + 1})) AS i)),
starts AS (
  SELECT id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster FROM kept),
c0 AS MATERIALIZED (
  SELECT CAST(cluster AS INTEGER) AS cluster, i, x FROM v JOIN starts USING (id) WHERE cluster < {k}),
{body},
inertia AS (SELECT cluster, sum(distance) AS s FROM a{rounds} GROUP BY cluster),
final AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM c{rounds} GROUP BY cluster)
SELECT kept.vec_id, a{rounds}.cluster, a{rounds}.distance,
       CAST(inertia.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM inertia) AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (id) JOIN inertia USING (cluster) JOIN final USING (cluster)"""


ORACLE: dict[str, str] = {
    "op11_collocations": collocations_sql(),
    "op12_ngram_join": ngram_join_sql(),
    "op13_centroid_clusters": centroid_clusters_sql(),
}
