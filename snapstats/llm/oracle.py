"""DuckDB SQL for the queries of this package that SQL can express; the others are tested against brute force."""

from __future__ import annotations

#: The line keys of the documents: lines in order, and per key the number of documents and the largest id.
LINES = """
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {docs}),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
         GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, pos, line, last IS NOT NULL AND doc_id < last AS gone FROM keyed LEFT JOIN held USING (key)),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM judged GROUP BY doc_id)
"""

ORACLE_SQL = {
    "op3_line_dedup": "WITH" + LINES.format(docs="documents")
    + "SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept",
    "op5_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
}
