"""SQL for the results of text operators that SQL can express, over the same tables."""

from __future__ import annotations

INFILL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS s FROM documents
), u AS (
    SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS k,
        CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4
    FROM d
), c AS (
    SELECT *, len(k) AS n, least(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS a, greatest(h1 % (len(k) + 1), h2 % (len(k) + 1)) AS b
    FROM u
), p AS (
    SELECT *, coalesce(array_to_string(k[1:a], ''), '') AS p, coalesce(array_to_string(k[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(k[b + 1:n], ''), '') AS x,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
        ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""

MINHASH = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT u, v FROM shared JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * common >= 80 * (a.n + b.n - common)
), either AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, v FROM reached JOIN either ON u = other
), least_ids AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_ids USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The codes by whole searches: every part against every entry, ``rounds`` new codebooks, then the codes."""
    apart = "list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))"
    steps = [f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS t(p)
), first_ids AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}
), book0 AS MATERIALIZED (
    SELECT p, e, x FROM parts JOIN first_ids USING (vec_id)
)"""]
    for r in range(rounds + 1):
        steps.append(f"""assigned{r} AS MATERIALIZED (
    SELECT vec_id, p, any_value(x) AS x, min(m) AS m FROM (
        SELECT a.vec_id, a.p, a.x, {{'far': {apart}, 'e': b.e}} AS m FROM parts a JOIN book{r} b ON a.p = b.p
    ) GROUP BY vec_id, p
)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
    SELECT p, m.e AS e, i, sum(x[i]) AS s, count(*) AS c FROM assigned{r}, (SELECT unnest(range(1, len(x) + 1)) AS i FROM (SELECT x FROM parts LIMIT 1))
    GROUP BY ALL
), means{r} AS (
    SELECT p, e, list(CAST((s - (s % c + c) % c) // c AS BIGINT) ORDER BY i) AS x FROM sums{r} GROUP BY p, e
), book{r + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN means{r} m USING (p, e)
)""")
    return ", ".join(steps) + f""", coded AS (
    SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.far) AS BIGINT) AS error FROM assigned{rounds} GROUP BY vec_id
), written AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), written
"""
