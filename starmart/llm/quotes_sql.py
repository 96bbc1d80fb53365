"""DuckDB SQL of quotation linking over a message table."""

_TREE = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS t, coalesce(CAST(conv_id AS VARCHAR), '') AS ck, coalesce(turn, -4611686018427387904) AS tk FROM {table}),
cut AS (SELECT r, ck, tk, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM (SELECT r, ck, tk, string_split(t, chr(10)) AS l FROM m)),
marked AS (SELECT *, regexp_extract(line, '^[ \t]*>(?:[ \t]*>)*[ \t]?') AS marks FROM cut),
lines AS (SELECT r, ck, tk, pos, length(replace(replace(marks, ' ', ''), chr(9), '')) AS level, substr(line, length(marks) + 1) AS body FROM marked),
turned AS (SELECT *, coalesce(level <> lag(level) OVER w, true) AS turns, trim(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g')) = '' AS blank FROM lines WINDOW w AS (PARTITION BY r ORDER BY pos)),
runs AS (SELECT *, sum(turns::INT) OVER w AS run, sum((turns OR blank)::INT) OVER w AS part FROM turned WINDOW w AS (PARTITION BY r ORDER BY pos)),
texts AS (
  SELECT r, ck, tk, level, run, string_agg(body, chr(10) ORDER BY pos) AS joined, 'run' AS kind FROM runs WHERE level > 0 GROUP BY ALL
  UNION ALL SELECT r, ck, tk, level, run, joined, 'part' FROM (SELECT r, ck, tk, level, run, part, string_agg(body, chr(10) ORDER BY pos) AS joined FROM runs WHERE level > 0 GROUP BY ALL)
  UNION ALL SELECT r, ck, tk, 0, 0, string_agg(body, chr(10) ORDER BY pos), 'whole' FROM runs WHERE level = 0 GROUP BY ALL
  UNION ALL SELECT r, ck, tk, 0, 0, joined, 'own part' FROM (SELECT r, ck, tk, part, string_agg(body, chr(10) ORDER BY pos) AS joined FROM runs WHERE level = 0 GROUP BY ALL)
  UNION ALL SELECT r, ck, tk, 0, 0, body, 'line' FROM runs WHERE level = 0),
normal AS (SELECT *, lower(trim(regexp_replace(joined, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM texts),
origin AS (SELECT ck, norm, min(tk) AS origin FROM normal WHERE level = 0 AND norm <> '' GROUP BY ALL),
passage AS (SELECT q.r, q.level, q.run, max(CASE WHEN o.origin < q.tk THEN o.origin END) AS origin FROM normal q LEFT JOIN origin o USING (ck, norm) WHERE q.level > 0 AND norm <> '' GROUP BY ALL),
per_row AS (SELECT r, count(*) AS n_quotes, count(origin) AS n_linked, max(level) AS max_level, max(CASE WHEN level = 1 THEN origin END) AS quoted FROM passage GROUP BY r),
kept AS (SELECT r, regexp_replace(joined, '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') AS joined FROM texts WHERE kind = 'whole'),
has AS (SELECT DISTINCT r FROM lines WHERE level > 0),
nodes AS (SELECT ck, tk, max(quoted) AS quoted FROM m LEFT JOIN per_row USING (r) GROUP BY ALL),
parents AS (SELECT ck, tk, coalesce(quoted, lag(tk) OVER (PARTITION BY ck ORDER BY tk)) AS parent FROM nodes),
tree AS (
  SELECT ck, tk, parent, tk AS root, 0 AS depth FROM parents WHERE parent IS NULL
  UNION ALL SELECT p.ck, p.tk, p.parent, t.root, t.depth + 1 FROM parents p JOIN tree t ON p.ck = t.ck AND p.parent = t.tk)
SELECT conv_id, turn, role, CASE WHEN has.r IS NULL THEN t ELSE coalesce(joined, '') END AS text,
  CASE WHEN parent <> -4611686018427387904 THEN parent END AS parent_turn, CASE WHEN root <> -4611686018427387904 THEN root END AS root_turn, CAST(depth AS BIGINT) AS depth,
  coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, CAST(coalesce(max_level, 0) AS BIGINT) AS max_level
FROM m JOIN tree USING (ck, tk) LEFT JOIN kept USING (r) LEFT JOIN per_row USING (r) LEFT JOIN has USING (r)
"""

_RENDERED = r"""(
  WITH told AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
  back AS (SELECT conv_id, turn, min(text) AS said FROM told GROUP BY ALL),
  one AS (SELECT told.*, told.turn - CASE WHEN told.turn % 3 = 2 THEN 2 ELSE 1 END AS t1 FROM told),
  two AS (SELECT *, t1 - CASE WHEN t1 % 3 = 2 THEN 2 ELSE 1 END AS t2 FROM one)
  SELECT two.conv_id, two.turn, role, concat_ws(chr(10), array_to_string(['>> ' || x FOR x IN string_split(b2.said, chr(10))], chr(10)),
    array_to_string(['> ' || x FOR x IN string_split(b1.said, chr(10))], chr(10)), text) AS text
  FROM two LEFT JOIN back b1 ON b1.conv_id = two.conv_id AND b1.turn = t1 LEFT JOIN back b2 ON b2.conv_id = two.conv_id AND b2.turn = t2)"""

LINKED = _TREE.format(table="conversations")
LINKED_RENDERED = _TREE.format(table=_RENDERED)
