"""Expected results of the operators as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

SQL: dict[str, str] = {}

# Windows are compared by their lines themselves; ids are unique in ``documents``.
SQL["op7_line_dedup"] = r"""
WITH pieces AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE text IS NOT NULL
), held AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
    FROM pieces WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
    SELECT doc_id, i, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
    FROM held WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), later AS (
    SELECT doc_id, i FROM windows WHERE c IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) > 1
), covered AS (
    SELECT DISTINCT doc_id, i + k AS i FROM later CROSS JOIN (VALUES (0), (1), (2)) AS span(k)
), gone AS (
    SELECT doc_id, place FROM held JOIN covered USING (doc_id, i)
), rest AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text
    FROM pieces ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id
), removed AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(lines.n, 0) AS n_lines, coalesce(removed.n, 0) AS n_removed,
       CASE WHEN removed.n IS NULL THEN d.text ELSE coalesce(rest.text, '') END AS text
FROM documents AS d
LEFT JOIN lines ON lines.doc_id = d.doc_id
LEFT JOIN removed ON removed.doc_id = d.doc_id
LEFT JOIN rest ON rest.doc_id = d.doc_id
"""
