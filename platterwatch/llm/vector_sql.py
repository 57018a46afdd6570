"""SQL of the queries over vectors and of the ranked search."""

from __future__ import annotations

from platterwatch.llm import near_vectors, ranked_search, vector_codes

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT r, vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
), link AS (
  SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= {near_vectors.THRESHOLD}
), reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (
  SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY a
), n AS (
  SELECT a, count(*) AS n_links FROM link GROUP BY a
)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least ON least.a = v.r LEFT JOIN n ON n.a = v.r
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, translate(text, '{UPPER}', '{LOWER}') AS t FROM documents
), tf AS (
  SELECT r, doc_id, term, count(*) AS tf
  FROM (SELECT r, doc_id, unnest(regexp_extract_all(t, '{TERM}')) AS term FROM d) GROUP BY ALL
), size AS (
  SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, n_docs
), share AS (
  SELECT r, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM size, total
), asked AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS q, item_id,
               unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
        FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT q, item_id, r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN share USING (r) GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= {ranked_search.TOP}
"""


def vector_codes_sql() -> str:
    """The rounds of the codebooks written out one after the other."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    steps = [
        f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         [CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), size AS (
  SELECT (max(len(e)) + {parts - 1}) // {parts} AS size FROM v
), p AS MATERIALIZED (
  SELECT r, k // size AS part, k % size AS place, coalesce(e[k + 1], 0) AS x
  FROM (SELECT r, e, size, unnest(range({parts} * size)) AS k FROM v, size)
), c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x FROM p WHERE r <= {entries})"""
    ]
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, part, CAST(min(apart * {entries} + entry) % {entries} AS BIGINT) AS entry,
         CAST(min(apart * {entries} + entry) // {entries} AS BIGINT) AS apart
  FROM (SELECT r, part, entry, sum((p.x - c.x) * (p.x - c.x)) AS apart
        FROM p JOIN c{k} c USING (part, place) GROUP BY r, part, entry) GROUP BY r, part
)"""
        )
        if k < vector_codes.ROUNDS:
            steps.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT part, entry, place,
         CAST(coalesce((total - ((total % n + n) % n)) // n, x) AS BIGINT) AS x
  FROM c{k} LEFT JOIN (SELECT part, entry, place, sum(x) AS total, count(*) AS n
                       FROM p JOIN a{k} USING (r, part) GROUP BY ALL) s USING (part, entry, place)
)"""
            )
    last = vector_codes.ROUNDS
    steps.append(
        f"""coded AS (
  SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error
  FROM a{last} GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c{last}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), books"""
    )
    return ", ".join(steps)


ORACLE = {
    "op11_near_vectors": NEAR_VECTORS,
    "op12_ranked_search": RANKED,
    "op13_vector_codes": vector_codes_sql(),
}
