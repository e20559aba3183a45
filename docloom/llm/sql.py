"""Those queries that SQL can say, for DuckDB over the same tables."""

from __future__ import annotations

from docloom.llm.chat import CONTROL, ESCAPE, LEARNED, OPEN

_ESC = f"chr({ord(ESCAPE)})"


def _escaped(column: str) -> str:
    out = f"replace({column}, {_ESC}, {_ESC} || {_ESC})"
    for string in CONTROL:
        out = f"replace({out}, '{string}', '{string[0]}' || {_ESC} || '-{string[1:]}')"
    return out


_CONFLICT = " OR ".join(f"contains(role, '{s}') OR contains(text, '{s}')" for s in CONTROL)

CONVERSATIONS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, '{LEARNED}', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, {len(OPEN)} + 1 + 4 + CASE WHEN {_CONFLICT} OR contains(role, chr(10))
    THEN length(replace({_escaped("role")}, chr(10), {_ESC} || 'n')) + length({_escaped("text")})
    ELSE length(role) + length(text) END AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs WHERE 100 * shared >= 75 * (n - shared)
  UNION ALL SELECT b, a FROM pairs WHERE 100 * shared >= 75 * (n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT links.b, reach.other FROM reach JOIN links ON links.a = reach.doc_id
), found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN found USING (doc_id)
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _nearest(assigned: str, centroids: str) -> str:
    return f"""{assigned} AS MATERIALIZED (
  SELECT row_id, vec_id, v, cluster, distance FROM (
    SELECT k.*, c.cluster, list_sum(list_transform(list_zip(v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
        AS distance FROM kept k, {centroids} c)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) = 1
)"""


def _round(number: int) -> str:
    return f"""{_nearest(f"a{number}", f"c{number}")}, c{number + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{number} c LEFT JOIN (
    SELECT cluster, list(mean ORDER BY place) AS c FROM (
      SELECT cluster, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
      FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{number})
      GROUP BY cluster, place) GROUP BY cluster) m USING (cluster)
)"""


_ROUNDS = 10

CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS HUGEINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest, v) - 1 AS cluster, v AS c FROM (
    SELECT sha256('3:' || vec_id) AS digest, v FROM kept ORDER BY digest, v LIMIT 8)
), {", ".join(_round(number) for number in range(_ROUNDS))}, {_nearest("final", f"c{_ROUNDS}")}
SELECT vec_id, CAST(f.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM final f JOIN c{_ROUNDS} c ON f.cluster = c.cluster
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(name) for name in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: Bit by bit: a byte is taken in, and eight steps of the polynomial follow.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
    range(strlen(CAST(doc_id AS VARCHAR))), lambda i: list_transform(range(8), lambda k: CASE WHEN k = 0
      THEN ascii(CAST(doc_id AS VARCHAR)[i + 1])::UBIGINT ELSE 0::UBIGINT END)))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1::UBIGINT))), 4294967295::UBIGINT)"""


def _grown(name: str, start: str) -> str:
    """Nodes of all trees, level by level; ``nodes`` counts the nodes of a tree on a level."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(nodes) + 2) // 3
  FROM {name} WHERE nodes > 1 GROUP BY tree, level, pos // 3
)"""


def _runs(name: str, nodes: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT n.tree, n.level, n.pos,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (WHERE o.pos < n.pos), '') AS before,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (WHERE o.pos > n.pos), '') AS after
  FROM {nodes} n JOIN {nodes} o ON n.tree = o.tree AND n.level = o.level AND n.pos // 3 = o.pos // 3
  WHERE n.nodes > 1 GROUP BY n.tree, n.level, n.pos
)"""


def _walked(name: str, start: str, runs: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT w.key, w.tree, w.level + 1, w.pos // 3, proof || before || after, sha256(before || node || after)
  FROM {name} w JOIN {runs} r ON w.tree = r.tree AND w.level = r.level AND w.pos = r.pos
)"""


MANIFEST = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT *, coalesce('+' || source, '') AS tree, row_number() OVER () AS key,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS nodes
  FROM (SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS forged
    FROM documents)
), {_grown("nodes", "SELECT tree, 0 AS level, pos, leaf AS digest, nodes FROM leaves")}, tops AS MATERIALIZED (
  SELECT tree AS of, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS nodes
  FROM nodes WHERE nodes = 1
), {_grown("upper", "SELECT '' AS tree, 0 AS level, pos, digest, nodes FROM tops")},
{_runs("runs", "nodes")}, {_runs("upper_runs", "upper")},
{_walked("walk", "SELECT key, tree, 0 AS level, pos, '' AS proof, forged AS node FROM leaves", "runs")},
reached AS MATERIALIZED (
  SELECT key, tree, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM walk GROUP BY key, tree
),
{_walked("last", "SELECT key, '' AS tree, 0 AS level, t.pos, proof, node FROM reached JOIN tops t ON t.of = reached.tree", "upper_runs")},
folded AS (SELECT key, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM last GROUP BY key),
root AS (SELECT digest AS root FROM upper WHERE nodes = 1)
SELECT l.doc_id, l.leaf, t.digest AS subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaves l JOIN tops t ON t.of = l.tree JOIN folded USING (key), root
"""
