"""SQL for the results of the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT g.doc_id, i FROM g JOIN f USING (s) WHERE first < g.doc_id),
    (SELECT unnest(range(13)) AS k)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_REACHED = """reached AS (SELECT DISTINCT a AS id, a AS other FROM links
  UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT id, min(other) AS component FROM reached GROUP BY id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(
    text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i
    FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
{_REACHED}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON id = doc_id"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b
  FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a),
{_REACHED}
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
  coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN degrees ON a = vec_id LEFT JOIN least ON id = vec_id"""


def _digest(columns) -> str:
    return "sha256(concat({}))".format(
        ", ".join(
            f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
            for c in columns
        )
    )


#: crc32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(
  list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
    lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
  lambda c, b: list_reduce(range(8),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
  CAST(4294967295 AS BIGINT)), 4294967295)"""

_TAMPERED = (
    f"CASE WHEN {_CRC32} % 3 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') "
    "ELSE text END"
)


def _merkle_levels(name: str, leaves: str) -> str:
    """Nodes of trees (tree, level, pos, digest, n nodes on their level)."""
    return f"""{name} AS (SELECT tree, 0 AS level, pos, digest, n FROM ({leaves})
  UNION ALL
  SELECT tree, level, pos, digest, count(*) OVER (PARTITION BY tree) FROM (
    SELECT tree, level + 1 AS level, pos // 8 AS pos,
      sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 8))"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE l AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree,
    {_digest(["doc_id", "source", "lang", "n_chars", "text"])} AS leaf,
    {_digest(["doc_id", "source", "lang", "n_chars", f"({_TAMPERED})"])} AS presented
  FROM documents),
p AS MATERIALIZED (SELECT r, doc_id, tree, leaf, presented, count(*) OVER (PARTITION BY tree) AS n,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
{_merkle_levels("low", "SELECT tree, pos, leaf AS digest, n FROM p")},
lows AS MATERIALIZED (SELECT * FROM low),
subroots AS (SELECT tree, digest, count(*) OVER () AS n,
  row_number() OVER (ORDER BY tree) - 1 AS pos FROM lows WHERE n = 1),
{_merkle_levels("high", "SELECT '' AS tree, pos, digest, n FROM subroots")},
highs AS MATERIALIZED (SELECT * FROM high),
steps AS (
  SELECT r, x.level, string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos < p.pos >> 3 * x.level) AS b,
    string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos > p.pos >> 3 * x.level) AS a
  FROM p JOIN lows x ON x.tree = p.tree AND x.n > 1
    AND x.pos // 8 = p.pos >> 3 * (x.level + 1)
  GROUP BY r, x.level
  UNION ALL
  SELECT r, 100 + x.level, string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos < s.pos >> 3 * x.level),
    string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos > s.pos >> 3 * x.level)
  FROM p JOIN subroots s ON s.tree = p.tree
    JOIN highs x ON x.n > 1 AND x.pos // 8 = s.pos >> 3 * (x.level + 1)
  GROUP BY r, x.level),
proofs AS MATERIALIZED (SELECT r, list(coalesce(b, '') ORDER BY level) AS b,
  list(coalesce(a, '') ORDER BY level) AS a FROM steps GROUP BY r),
folds AS (SELECT r, 0 AS k, presented AS digest FROM p
  UNION ALL
  SELECT r, k + 1, sha256(concat(b[k + 1], digest, a[k + 1]))
  FROM folds JOIN proofs USING (r) WHERE k < len(b)),
folded AS (SELECT r, arg_max(digest, k) AS digest FROM folds GROUP BY r)
SELECT doc_id, leaf, subroots.digest AS subroot, highs.digest AS root,
  sha256(coalesce(list_aggregate(list_transform(range(1, len(b) + 1), lambda k: b[k] || a[k]),
    'string_agg', ''), '')) AS proof_sha256,
  folded.digest AS folded_root, folded.digest = highs.digest AS verified
FROM p JOIN subroots USING (tree) JOIN highs ON highs.n = 1 JOIN folded USING (r)
  LEFT JOIN proofs USING (r)"""


def _rounds(rounds: int) -> str:
    """Assignments a0, a1, ... to the centroids c0, c1, ..., which move between them."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (SELECT r, arg_min(c, (distance, c)) AS c,
    min(distance) AS distance FROM (
      SELECT v.r, m.c, sum((v.x - m.x) * (v.x - m.x)) AS distance
      FROM v JOIN c{r} m USING (d) GROUP BY v.r, m.c) GROUP BY r)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, d, coalesce(n.x, o.x) AS x
  FROM c{r} o LEFT JOIN (SELECT c, d, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
    FROM a{r} JOIN v USING (r) GROUP BY c, d) n USING (c, d))""")
    return ",\n".join(out)


CENTROID_CLUSTERING = f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, d, CAST(floor(1024 * e[d]) AS BIGINT) AS x
  FROM (SELECT r, e, unnest(range(1, 65)) AS d FROM k)),
c0 AS MATERIALIZED (SELECT c, d, x FROM (
    SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM k
    ORDER BY c LIMIT 8) JOIN v USING (r)),
{_rounds(10)},
sums AS (SELECT c, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a10 GROUP BY c),
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
  FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(distance AS BIGINT) AS distance, cluster_inertia,
  (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM sums) AS inertia, centroid_sha256
FROM a10 JOIN k USING (r) JOIN sums USING (c) JOIN named USING (c)"""
