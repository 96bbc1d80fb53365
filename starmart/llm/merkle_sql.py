"""DuckDB SQL of ``op12_merkle_manifest``: the trees by sorted numbering and recursion, the checksum by its polynomial."""

from __future__ import annotations

_PARTS = ["doc_id", "source", "lang", "n_chars"]


def _told(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_told(c) for c in [*_PARTS, text]) + ")"


# fixed values: the reversed polynomial, the start and the final value of CRC-32
_STEP = "list_reduce(range(0, 9), lambda a, i: CASE WHEN i = 0 THEN a WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, xor(crc, CAST(x AS BIGINT)))"
_CRC = f"xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, x: {_STEP}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


def _tree(name: str, base: str) -> str:
    """Nodes (tree, level, i, n, h) of the trees over ``base`` (tree, level 0, i, n, h)."""
    return f"""{name} AS (
  SELECT * FROM {base}
  UNION ALL
  SELECT tree, level + 1, i // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3
)"""


def _sides(name: str, tree: str) -> str:
    """For every node that has a parent: the digests beside it, left and right."""
    side = "coalesce(string_agg(h, '' ORDER BY i) OVER (PARTITION BY tree, level, i // 3 ORDER BY i ROWS BETWEEN {}), '')"
    before, after = side.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
    return f"{name} AS (SELECT tree, level, i, {before} AS l, {after} AS r FROM {tree} WHERE n > 1)"


MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS seen
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), base AS (SELECT tree, 0 AS level, i, n, leaf AS h FROM placed),
{_tree('nodes', 'base')},
{_sides('sides', 'nodes')},
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
top_base AS (SELECT 0 AS tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM subroots),
{_tree('top', 'top_base')},
{_sides('top_sides', 'top')},
sources AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS at FROM subroots),
climb AS (
  SELECT doc_id, p.tree, i, leaf, 0 AS level, i AS at, n, '' AS proof, seen AS h FROM placed p
  UNION ALL
  SELECT c.doc_id, c.tree, c.i, c.leaf, c.level + 1, c.at // 3, (c.n + 2) // 3, c.proof || s.l || s.r, sha256(s.l || c.h || s.r)
  FROM climb c JOIN sides s ON s.tree = c.tree AND s.level = c.level AND s.i = c.at WHERE c.n > 1
), climb_top AS (
  SELECT doc_id, c.tree, c.i, leaf, subroot, 0 AS level, s.at, (SELECT count(*) FROM sources) AS n, proof, h FROM climb c JOIN sources s USING (tree) WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.tree, c.i, c.leaf, c.subroot, c.level + 1, c.at // 3, (c.n + 2) // 3, c.proof || s.l || s.r, sha256(s.l || c.h || s.r)
  FROM climb_top c JOIN top_sides s ON s.level = c.level AND s.i = c.at WHERE c.n > 1
)
SELECT doc_id, leaf, subroot, r.root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = r.root AS verified
FROM climb_top c CROSS JOIN (SELECT h AS root FROM top WHERE n = 1) r WHERE c.n = 1
"""
