"""DuckDB SQL of ``op8_repetition``: n-grams as lists, counted per text; the shares over the words they cover."""

from __future__ import annotations

from starmart.llm.repetition import LEAST_WORDS, LINE_SHARE, NGRAM_SHARES, WINDOW_WORDS

_NS = sorted({WINDOW_WORDS, *NGRAM_SHARES})
_COVERED = ", ".join(
    f"coalesce(sum(length(word)) FILTER (WHERE n{n}), 0) AS chars{n}, count(*) FILTER (WHERE n{n}) AS words{n}" for n in _NS
)
_FEW = " AND ".join(f"dup_{n}gram_share <= {most}" for n, most in NGRAM_SHARES.items())

RULES = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
listed AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
sizes AS (SELECT unnest([{', '.join(map(str, _NS))}]) AS n),
grams AS (
  SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS times
  FROM (SELECT doc_id, n, i, list_slice(ws, i, i + n - 1) AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM listed, sizes WHERE len(ws) >= n))
),
covered AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM grams WHERE times > 1),
flags AS (SELECT doc_id, i, {', '.join(f'bool_or(n = {n}) AS n{n}' for n in _NS)} FROM covered GROUP BY doc_id, i),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM listed),
counted AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, {_COVERED}
  FROM words LEFT JOIN flags USING (doc_id, i) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS i FROM docs),
again AS (
  SELECT doc_id, length(line) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS later
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dups AS (SELECT doc_id, count(*) FILTER (WHERE later) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE later), 0) AS dup_chars, sum(chars) AS chars FROM again GROUP BY doc_id),
joined AS (
  SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(words{WINDOW_WORDS}, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(dup_chars, 0) AS DOUBLE) / greatest(coalesce(d.chars, 0), 1) AS dup_line_share,
    {', '.join(f'CAST(coalesce(chars{n}, 0) AS DOUBLE) / greatest(coalesce(word_chars, 0), 1) AS dup_{n}gram_share' for n in NGRAM_SHARES)}
  FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN dups d USING (doc_id)
)
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 30 * n_words) AND dup_line_share <= {LINE_SHARE} AND {_FEW} AS kept
FROM joined
"""
