"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

ORACLE = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# equal sets meet once, as in the operator; their copies join the class by the set itself
ORACLE["op2_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _FOLD.format("coalesce(text, '')"))} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM w
), reps AS (
  SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS (
  SELECT rep, n, unnest(s) AS t FROM reps
), pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(rep, id) AS (
  SELECT rep, rep FROM reps UNION SELECT reach.rep, edges.b FROM reach JOIN edges ON reach.id = edges.a
), comp AS (
  SELECT rep, min(id) AS c FROM reach GROUP BY rep
)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(comp.c, sets.doc_id) AS component_id
FROM sets LEFT JOIN reps ON sets.s = reps.s LEFT JOIN comp ON reps.rep = comp.rep
"""

ORACLE["op7_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
    {_FOLD.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines
), common AS (
  SELECT k, max(doc_id) AS keep_doc FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT keyed.doc_id, pos, line, common.k IS NOT NULL AND keyed.doc_id <> common.keep_doc AS gone
  FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op9_substring_dedup"] = f"""
WITH w AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)
), earliest AS (
  SELECT t, min(doc_id) AS d FROM windows GROUP BY t
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN earliest ON windows.t = earliest.t AND windows.doc_id > earliest.d
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w
), kept AS (
  SELECT words.doc_id, count(gone.i) AS n_removed,
    string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(kept.n_removed, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
