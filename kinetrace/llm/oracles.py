"""DuckDB SQL of queries that SQL can express, for whole tables of test size."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def decontamination(window: int = 10) -> str:
    words = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT item, w, least({window}, len(w)) AS n, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS i FROM b WHERE len(w) > 0),
p AS (SELECT item, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM i),
v AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p)),
h AS (SELECT v.doc_id, v.i, v.n, p.item FROM v JOIN p ON p.n = v.n AND p.p = array_to_string(v.w[v.i:v.i + v.n - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT at_) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS at_ FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def near_duplicates(k: int = 4, threshold: int = 80) -> str:
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {k - 1}) + 1)) AS i FROM d WHERE len(w) > 0)),
s AS (SELECT DISTINCT doc_id, g FROM g), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {threshold} * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, m AS component_id, m = doc_id AS kept FROM (SELECT doc_id, min(other) AS m FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


WARC = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to FROM m
"""
