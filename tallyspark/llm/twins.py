"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

WORD = r"'[^ \t-\r]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def found(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern}'))"


ORACLE: dict[str, str] = {
    "op2_quality_rules": rf"""
      WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      parts AS (
        SELECT doc_id, t, regexp_extract_all(t, {WORD}) AS w,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {WORD})) AS lines
        FROM texts),
      grams AS (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM parts)),
      again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
      covered AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
      counts AS (
        SELECT doc_id, t, len(lines) AS n_lines, len(w) AS n_words,
          length(regexp_replace(t, {WORD.replace("^", "")}, '', 'g')) AS word_chars,
          {found("[#*$%&|<>]")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
          coalesce(n, 0) AS n_repeat_words
        FROM parts LEFT JOIN covered USING (doc_id)),
      based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed
          OR n_symbols > 0.3::DOUBLE * n_words
          OR {found("!!")} > 0.3::DOUBLE * n_words
          OR {found(r"\p{L}")} < 0.5::DOUBLE * word_chars
          OR length(t) > 40 * n_words
          OR n_dup_lines > 0.5::DOUBLE * n_lines) AS kept
      FROM based""",
    "op3_near_dedup": rf"""
      WITH RECURSIVE tokens AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORD}) AS w
        FROM documents),
      sets AS (
        SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4
            THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END)) AS s
        FROM tokens),
      nodes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
      each AS (SELECT node, n, unnest(list_transform(s, lambda g: hash(g))) AS g FROM nodes),
      pairs AS (
        SELECT x.node AS a, y.node AS b, x.n AS m, y.n AS n, count(*) AS shared
        FROM each x JOIN each y ON x.g = y.g AND x.node < y.node
          AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        GROUP BY ALL),
      linked AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (m + n - shared)),
      edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
      reach AS (
        SELECT node, node AS label FROM nodes
        UNION SELECT e.b, r.label FROM reach r JOIN edges e ON e.a = r.node WHERE r.label < e.b),
      labels AS (SELECT node, min(label) AS label FROM reach GROUP BY node)
      SELECT sets.doc_id, len(sets.s) AS n_shingles, coalesce(label, sets.doc_id) AS component_id,
        coalesce(label, sets.doc_id) = sets.doc_id AS kept
      FROM sets LEFT JOIN nodes ON len(sets.s) > 0 AND nodes.s = sets.s LEFT JOIN labels USING (node)""",
}
