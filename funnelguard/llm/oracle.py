"""DuckDB SQL of the manifest, the MinHash and the clustering query, each from its definition."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# DuckDB has no CRC-32: the table by its polynomial, then one step for each digit of the id
CRC32 = """
bits AS (SELECT b, 0 AS k, CAST(b AS UBIGINT) AS v FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
crc_steps AS (SELECT s, 0 AS i, CAST(4294967295 AS UBIGINT) AS v FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT s, i + 1, xor(v // 256, t[CAST(xor(v % 256, CAST(ascii(s[i + 1]) AS UBIGINT)) AS INTEGER) + 1]) FROM crc_steps, crc_table WHERE i < length(s)),
crc AS MATERIALIZED (SELECT s, xor(v, 4294967295) AS v FROM crc_steps WHERE i = length(s))"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf(count: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", count, "text")) + ")"


def _folded(name: str, start: str) -> str:
    """Nodes (g, level, i, digest, n) of a fold of ``start`` (g, i, digest, n)."""
    return f"""{name} AS (SELECT g, 0 AS level, i, digest, n FROM {start}
  UNION ALL SELECT g, level + 1, i // 2, digest, (n + 1) // 2 FROM (
    SELECT g, level, i, n, sha256(digest || coalesce(lead(digest) OVER (PARTITION BY g, level ORDER BY i), '')) AS digest
    FROM {name} WHERE n > 1) WHERE i % 2 = 0)"""


MERKLE = f"""
WITH RECURSIVE {CRC32.strip()},
leaves AS MATERIALIZED (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE 'v' || lang END AS g, {_leaf('n_chars')} AS leaf,
    CASE WHEN v % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS used
  FROM documents LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR)),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
own AS (SELECT g, i, leaf AS digest, n FROM placed),
{_folded('nodes', 'own')},
kept_nodes AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (SELECT 't' AS g, g AS name, digest, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM kept_nodes WHERE n = 1),
{_folded('upper_nodes', 'subroots')},
kept_upper AS MATERIALIZED (SELECT * FROM upper_nodes),
steps AS MATERIALIZED (
  SELECT p.g, p.i AS leaf_at, p.doc_id, a.level, a.i % 2 AS digit, b.digest AS other
  FROM placed p JOIN kept_nodes a ON a.g = p.g AND a.i = p.i // CAST(pow(2, a.level) AS BIGINT) AND a.n > 1
  LEFT JOIN kept_nodes b ON b.g = a.g AND b.level = a.level AND b.i = xor(a.i, 1)
  UNION ALL
  SELECT p.g, p.i, p.doc_id, 100 + a.level, a.i % 2, b.digest
  FROM placed p JOIN subroots s ON s.name = p.g JOIN kept_upper a ON a.i = s.i // CAST(pow(2, a.level) AS BIGINT) AND a.n > 1
  LEFT JOIN kept_upper b ON b.level = a.level AND b.i = xor(a.i, 1)),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g, leaf_at ORDER BY level) AS k FROM steps),
folds AS (SELECT g, i AS leaf_at, used AS digest, CAST(0 AS BIGINT) AS k FROM placed
  UNION ALL SELECT f.g, f.leaf_at, sha256(CASE WHEN n.other IS NULL THEN f.digest WHEN n.digit = 1 THEN n.other || f.digest ELSE f.digest || n.other END), n.k
  FROM folds f JOIN numbered n ON n.g = f.g AND n.leaf_at = f.leaf_at AND n.k = f.k + 1),
ends AS (SELECT g, leaf_at, arg_max(digest, k) AS folded_root FROM folds GROUP BY g, leaf_at),
proofs AS (SELECT g, leaf_at, sha256(coalesce(string_agg(other, '' ORDER BY k), '')) AS proof_sha256 FROM numbered GROUP BY g, leaf_at),
top AS (SELECT digest AS root FROM kept_upper WHERE n = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots s ON s.name = p.g JOIN ends e ON e.g = p.g AND e.leaf_at = p.i
LEFT JOIN proofs q ON q.g = p.g AND q.leaf_at = p.i CROSS JOIN top"""

MINHASH = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
edges AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, y AS other FROM edges UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
lowest AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)"""


def _rounds(count: int) -> str:
    """The CTEs of ``count`` rounds, and the assignment to the last centroids (a10 of ten)."""
    found = []
    for r in range(count + 1):
        found.append(f"""a{r} AS MATERIALIZED (SELECT r, k, dist FROM (
    SELECT x.r, c.k, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM cells x JOIN c{r} c USING (d) GROUP BY x.r, c.k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, k) = 1)""")
        if r < count:
            found.append(f"""m{r} AS (SELECT k, d, sum(v) AS s, count(*) AS n FROM cells JOIN a{r} USING (r) GROUP BY k, d),
c{r + 1} AS MATERIALIZED (SELECT k, d, CAST(coalesce((s - ((s % n + n) % n)) // n, v) AS BIGINT) AS v FROM c{r} LEFT JOIN m{r} USING (k, d))""")
    return ",\n".join(found)


CENTROIDS = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND coalesce(isfinite(x), false)))),
cells AS MATERIALIZED (SELECT r, d, CAST(floor(1024 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS v FROM kept, range(1, 65) t(d)),
c0 AS MATERIALIZED (SELECT k, d, v FROM (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept QUALIFY k < 8) JOIN cells USING (r)),
{_rounds(10)},
sums AS (SELECT k, CAST(sum(dist) AS BIGINT) AS cluster_inertia FROM a10 GROUP BY k),
whole AS (SELECT CAST(sum(dist) AS BIGINT) AS inertia FROM a10),
names AS (SELECT k, sha256(string_agg(v, ',' ORDER BY d)) AS centroid_sha256 FROM c10 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, cluster_inertia, inertia, centroid_sha256
FROM a10 JOIN kept USING (r) JOIN sums USING (k) JOIN names USING (k) CROSS JOIN whole"""

ORACLE_SQL = {"op11_merkle_manifest": MERKLE, "op12_minhash_near_dedup": MINHASH, "op13_centroid_clustering": CENTROIDS}
