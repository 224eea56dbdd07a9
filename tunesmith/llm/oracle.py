"""DuckDB SQL of the training-data operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    bit = "lambda k, i: xor(k >> 1, 3988292384 * (k & 1))"
    byte = f"lambda c, b: list_reduce(range(8), {bit}, xor(c, CAST(ascii(b) AS BIGINT)))"
    return f"xor(list_reduce(string_split({text}, ''), {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', CAST({x} AS VARCHAR)) END"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


_UP = "list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))"
_SIDES = ("array_to_string(nodes[pos // 8 * 8 + 1:pos], '') AS l, "
          "array_to_string(nodes[pos + 2:pos // 8 * 8 + 8], '') AS r")

TOP_PRODUCTS = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.uid, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.uid <> b.uid AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank
      FROM pairs)
WHERE rank <= 5
"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(
           strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS idx
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY idx) AS turns,
         {crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h
  FROM turns GROUP BY conv_id),
whole AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
paths AS (
  SELECT conv_id, depth, len(turns) AS m, coalesce(length(turns[depth].text), 0) AS size,
         sha256(CAST(to_json(turns[1:depth]) AS VARCHAR)) AS node,
         CASE WHEN depth > 0 THEN sha256(CAST(to_json(turns[1:depth - 1]) AS VARCHAR)) END AS up
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM whole)),
nodes AS (
  SELECT depth, node, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size
  FROM paths GROUP BY depth, node),
children AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
ends AS (
  SELECT depth, node, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM paths WHERE depth = m GROUP BY 1, 2),
known AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, node)),
sums AS (
  SELECT p.depth, p.node, CAST(sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((k.n_convs - 1) * k.size) AS BIGINT) AS saved_tokens
  FROM known k JOIN paths p ON p.conv_id = k.conv_id AND p.depth <= k.depth GROUP BY 1, 2)
SELECT k.conv_id, k.depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM known k JOIN sums s USING (depth, node)
LEFT JOIN nodes u ON u.depth = k.depth - 1 AND u.node = k.up
LEFT JOIN ends e ON e.depth = k.depth AND e.node = k.node
"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS start
  FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY idx) FROM numbered GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_UP} FROM tree WHERE len(nodes) > 1),
subs AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS at_
  FROM tree WHERE len(nodes) = 1),
top_(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY at_) FROM subs HAVING count(*) > 0
  UNION ALL SELECT level + 1, {_UP} FROM top_ WHERE len(nodes) > 1),
root_ AS (SELECT nodes[1] AS root FROM top_ WHERE len(nodes) = 1),
steps AS (
  SELECT lang, idx, level, {_SIDES}
  FROM (SELECT n.lang, n.idx, t.level, t.nodes, n.idx // CAST(pow(8, t.level) AS BIGINT) AS pos
        FROM numbered n JOIN tree t ON t.lang IS NOT DISTINCT FROM n.lang WHERE len(t.nodes) > 1)
  UNION ALL
  SELECT lang, idx, level + 1000, {_SIDES}
  FROM (SELECT n.lang, n.idx, t.level, t.nodes, s.at_ // CAST(pow(8, t.level) AS BIGINT) AS pos
        FROM numbered n JOIN subs s ON s.lang IS NOT DISTINCT FROM n.lang, top_ t WHERE len(t.nodes) > 1)),
paths AS (SELECT lang, idx, list({{'l': l, 'r': r}} ORDER BY level) AS steps FROM steps GROUP BY lang, idx),
folded AS (
  SELECT n.doc_id, n.leaf, s.subroot, root,
         sha256(coalesce(array_to_string(list_transform(p.steps, lambda x: concat(x.l, x.r)), ''), '')) AS proof_sha256,
         CASE WHEN p.steps IS NULL THEN n.start
              ELSE list_reduce(p.steps, lambda acc, x: sha256(concat(x.l, acc, x.r)), n.start) END AS folded_root
  FROM numbered n JOIN subs s ON s.lang IS NOT DISTINCT FROM n.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM n.lang AND p.idx = n.idx, root_)
SELECT *, folded_root = root AS verified FROM folded
"""
