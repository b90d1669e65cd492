"""DuckDB SQL, by brute force, of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_GIVEN = """embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

SQL["op4_embedding_neardup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE {_GIVEN}
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.95::DOUBLE),
reach AS (SELECT a AS root, b AS vec_id FROM links UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.vec_id),
least AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY vec_id),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT m.vec_id, coalesce(d.n, 0) AS n_links, least(coalesce(t.root, m.vec_id), m.vec_id) AS component_id,
  m.vec_id = least(coalesce(t.root, m.vec_id), m.vec_id) AS kept
FROM embeddings m LEFT JOIN degree d ON d.a = m.vec_id LEFT JOIN least t ON t.vec_id = m.vec_id
"""

SQL["op7_exact_topk"] = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE {_GIVEN})
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
WHERE rank <= 5
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL["op6_ngram_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
reach AS (SELECT a AS root, b AS doc_id FROM links UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.doc_id),
least AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(coalesce(t.root, d.doc_id), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least t ON t.doc_id = d.doc_id
"""


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
_KINDS = [
    ("assign", rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
]


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, {number} AS no, '{kind}' AS kind, length(coalesce(values[i], '')) >= {least} AS counts,
    list_sum(list_transform(gaps[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda s: length(s))), 0) AS a,
    length(found[i]) AS n
  FROM (SELECT doc_id, gaps, found, values, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found,
      regexp_extract_all(t, '{pattern}', {group}) AS values
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))"""


_ALL = "\n  UNION ALL".join(_spans(i, *k) for i, k in enumerate(_KINDS))
_LIST = "string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT), ',' ORDER BY a, no)"

SQL["op5_secret_scan"] = f"""
WITH f AS (SELECT * FROM ({_ALL}) WHERE counts),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, {_LIST} FILTER (no < 3) AS base, {_LIST} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id
"""

# The table of CRC-32 by its rule; 3988292384 is the reversed polynomial.
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC32 = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT),
  lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""
_LEAF = "sha256(" + " || ".join(
    f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"

SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k: {_STEP}, x)) AS crc),
rows AS (
  SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN {_CRC32} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS begun
  FROM documents, bits),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i FROM rows),
nodes AS (
  SELECT 0 AS level, tree, i, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM numbered
  UNION ALL
  SELECT level + 1, tree, i // 3, sha256(string_agg(digest, '' ORDER BY i)), CAST(ceil(n / 3) AS BIGINT) FROM nodes WHERE n > 1 GROUP BY level, tree, i // 3, n),
tops AS (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
crown AS (
  SELECT 0 AS level, tree - 1 AS i, subroot AS digest, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), CAST(ceil(n / 3) AS BIGINT) FROM crown WHERE n > 1 GROUP BY level, i // 3, n),
root AS (SELECT digest AS root FROM crown WHERE n = 1),
met AS (
  SELECT l.tree, l.i AS leaf_i, s.level, s.i < l.i // (3 ** s.level)::BIGINT AS before, s.i, s.digest
  FROM numbered l JOIN nodes s ON s.tree = l.tree AND s.i // 3 = l.i // (3 ** (s.level + 1))::BIGINT AND s.n > 1
  UNION ALL
  SELECT l.tree, l.i, 100 + s.level, s.i < (l.tree - 1) // (3 ** s.level)::BIGINT, s.i, s.digest
  FROM numbered l JOIN crown s ON s.i // 3 = (l.tree - 1) // (3 ** (s.level + 1))::BIGINT AND s.n > 1),
others AS (
  SELECT m.*, m.i = CASE WHEN level < 100 THEN leaf_i // (3 ** level)::BIGINT ELSE (tree - 1) // (3 ** (level - 100))::BIGINT END AS own FROM met m),
steps AS (
  SELECT tree, leaf_i, level, coalesce(string_agg(digest, '' ORDER BY i) FILTER (before AND NOT own), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY i) FILTER (NOT before AND NOT own), '') AS r,
    row_number() OVER (PARTITION BY tree, leaf_i ORDER BY level) AS k
  FROM others GROUP BY tree, leaf_i, level),
proofs AS (SELECT tree, leaf_i, string_agg(l || r, '' ORDER BY k) AS proof FROM steps GROUP BY tree, leaf_i),
folds AS (
  SELECT tree, i, begun AS acc, 0::BIGINT AS k FROM numbered
  UNION ALL
  SELECT f.tree, f.i, sha256(s.l || f.acc || s.r), s.k FROM folds f JOIN steps s ON s.tree = f.tree AND s.leaf_i = f.i AND s.k = f.k + 1),
folded AS (SELECT tree, i, arg_max(acc, k) AS folded_root FROM folds GROUP BY tree, i)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM numbered JOIN tops USING (tree) JOIN folded USING (tree, i) LEFT JOIN proofs ON proofs.tree = numbered.tree AND proofs.leaf_i = numbered.i, root
"""
