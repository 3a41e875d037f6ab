"""DuckDB statements for the operators that SQL can state from their
definition: every pair is compared, nothing is filtered beforehand."""

from __future__ import annotations

_REACH = """
    reach(v, low) AS (
        SELECT v, v FROM nodes
        UNION
        SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.v WHERE r.low < e.b)"""

#: pages whose html lies in at least 100 bytes are compared by the whole html
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
     s AS (SELECT body, min(page_id) AS lead FROM p WHERE n >= 100 GROUP BY body)
SELECT p.page_id, p.n AS payload_bytes, sha256(p.body) AS payload_digest,
       CASE WHEN s.lead < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN s.lead < p.page_id THEN s.lead END AS refers_to
FROM p LEFT JOIN s ON p.body = s.body"""

#: components by the smallest vec_id that reaches a vector over direct links
VECTORS = f"""
WITH RECURSIVE good AS (
        SELECT vec_id, len(embedding) AS m, list_transform(embedding, lambda x: x::double) AS e FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     edges AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.m = b.m AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
     nodes AS (SELECT DISTINCT a AS v FROM edges),{_REACH},
     low AS (SELECT v, min(low) AS low FROM reach GROUP BY v),
     n AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT x.vec_id, coalesce(n.n, 0) AS n_links, coalesce(low.low, x.vec_id) AS component_id, coalesce(low.low, x.vec_id) = x.vec_id AS kept
FROM embeddings x LEFT JOIN n ON n.a = x.vec_id LEFT JOIN low ON low.v = x.vec_id"""


def shingles_sql(words: int = 4, percent: int = 85) -> str:
    """Documents linked by the exact Jaccard similarity of their shingles."""
    return f"""
WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     g AS MATERIALIZED (
        SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + {words - 1}], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
     size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
     edges AS MATERIALIZED (
        SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS both FROM g p JOIN g q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
        JOIN size s ON s.doc_id = x.a JOIN size t ON t.doc_id = x.b
        WHERE 100 * x.both >= {percent} * (s.n + t.n - x.both)),
     nodes AS (SELECT DISTINCT a AS v FROM edges),{_REACH},
     low AS (SELECT v, min(low) AS low FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(low.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id LEFT JOIN low ON low.v = d.doc_id"""
