"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = (
    "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLES["op10_decontaminate"] = f"""
WITH words AS (
    SELECT doc_id, coalesce({_ALNUM_WORDS.format("text")}, []) AS w FROM documents
), item_words AS (
    SELECT item_id, {_ALNUM_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL
), phrases AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size,
           array_to_string(w[i:i + 12], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
          FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM phrases
), places AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM words, sizes WHERE len(w) >= size)
), found AS (
    SELECT doc_id, i, p.size, item_id FROM places JOIN phrases p USING (size, phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found
          WHERE item_id IS NOT NULL)
    GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_TRIMMED = "trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"

ORACLES["op5_line_dedup"] = f"""
WITH pages AS (
    SELECT row_number() OVER () AS page, doc_id, coalesce('h' || source, '') AS host, text
    FROM documents
), line AS (
    SELECT page, host, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM pages
), keyed AS (
    SELECT *, {_TRIMMED} AS key FROM line
), totals AS (
    SELECT host, count(*) AS pages FROM pages GROUP BY host
), dropped AS (
    SELECT host, key FROM keyed JOIN totals USING (host) WHERE key <> ''
    GROUP BY host, key, pages
    HAVING count(DISTINCT page) >= 5 AND count(DISTINCT page) > 0.05 * pages
), kept AS (
    SELECT page, count(*) AS n_lines,
           count(*) FILTER (WHERE d.key IS NOT NULL) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE d.key IS NULL), '') AS text
    FROM keyed k LEFT JOIN dropped d ON k.host = d.host AND k.key = d.key
    GROUP BY page
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, kept.text
FROM pages LEFT JOIN kept USING (page)
"""

ORACLES["op8_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
    SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest
    FROM payloads
), responses AS (
    SELECT payload_digest, max(page_id) AS response FROM digests
    WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM digests LEFT JOIN responses USING (payload_digest)
"""


def _clusters_sql(rounds: int = 3) -> str:
    """Every round as its own step: nearest centroids, then rounded-down means."""
    steps = [
        """kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
), centroids0 AS MATERIALIZED (
    SELECT c, x FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM kept)
    WHERE c < 16
)"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""near{n} AS MATERIALIZED (
    SELECT vec_id, min({{'distance': distance, 'c': c}}) AS best, any_value(x) AS x
    FROM (SELECT vec_id, k.x, c,
                 CAST(list_sum(list_transform(list_zip(k.x, t.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
                      AS BIGINT) AS distance
          FROM kept k, centroids{n} t)
    GROUP BY vec_id
)""")
        if n < rounds:
            steps.append(f"""centroids{n + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.x, t.x) AS x FROM centroids{n} t LEFT JOIN (
        SELECT c, list((s - ((s % n + n) % n)) // n ORDER BY place) AS x
        FROM (SELECT best.c AS c, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
              FROM (SELECT best, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM near{n})
              GROUP BY 1, 2)
        GROUP BY c) m USING (c)
)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(t.x, ',')) AS centroid_sha256
FROM near{rounds} JOIN centroids{rounds} t ON t.c = best.c"""


ORACLES["op12_centroid_clusters"] = _clusters_sql()

_TERMS = (
    "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

ORACLES["op11_ranked_search"] = f"""
WITH words AS (
    SELECT row_number() OVER () AS doc, doc_id,
           list_transform({_TERMS.format("text")}, lambda t: {_LOWER.format("t")}) AS w
    FROM documents WHERE text IS NOT NULL
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words WHERE len(w) > 0
), item_words AS (
    SELECT row_number() OVER () AS item, item_id,
           list_transform({_TERMS.format("text")}, lambda t: {_LOWER.format("t")}) AS w
    FROM benchmark WHERE text IS NOT NULL
), item_terms AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(w) AS term FROM item_words) GROUP BY ALL
), counts AS (
    SELECT doc, doc_id, n, term, count(*) AS tf
    FROM (SELECT doc, doc_id, len(w) AS n, unnest(w) AS term FROM words)
    WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), impacts AS (
    SELECT doc, doc_id, term,
           (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)) AS impact
    FROM counts, totals
), scores AS (
    SELECT item, item_id, doc, doc_id, CAST(sum(times * weight * impact) AS BIGINT) AS score
    FROM item_terms JOIN weights USING (term) JOIN impacts USING (term)
    GROUP BY item, item_id, doc, doc_id
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
      FROM scores WHERE score > 0)
WHERE place <= 10
"""
