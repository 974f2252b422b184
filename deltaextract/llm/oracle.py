"""SQL (DuckDB dialect) for those queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

# CRC-32 by its table, which follows from the polynomial.
_RESAMPLING = rf"""
WITH crc AS (
    SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
    FROM range(256) t(i)
), docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
target AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
source AS (SELECT doc_id, unnest(words) AS word FROM docs),
distinct_words AS (SELECT word FROM source UNION SELECT word FROM target),
octets AS (SELECT word, hex(encode(word)) AS h FROM distinct_words),
hashed AS (
    SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(h), 2), lambda i: CAST('0x' || h[i + 1:i + 2] AS BIGINT))),
                                 lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM octets, crc
), s AS (SELECT bucket, count(*) AS n FROM source JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM source) AS s_all, (SELECT count(*) FROM target) AS t_all),
gain AS (
    SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS g
    FROM s LEFT JOIN t USING (bucket), totals
), weights AS (SELECT doc_id, sum(g) AS weight FROM source JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (doc_id)
), eligible AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN eligible USING (doc_id)
"""

_DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS g FROM starts),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM docs, (SELECT DISTINCT size FROM windows)),
found AS (SELECT doc_id, k, size, item_id FROM (SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS g FROM places) JOIN windows USING (size, g)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(k, k + size)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_AUDIT = r"""
WITH words AS (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
    SELECT coalesce(source, '') AS part,
           [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
            100 * length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) > 2 * length(coalesce(text, '')),
            regexp_matches(coalesce(text, ''), '[#$%&*|]'),
            doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, ''))] AS f,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = words.doc_id AND l.quality = 1) AS good,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = words.doc_id AND l.toxic = 1) AS toxic
    FROM words
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, strpos('ABCDE', filter_order[step]) AS k,
           list_transform(range(1, step), lambda i: strpos('ABCDE', filter_order[i])) AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), grouped AS (SELECT part, f, good, toxic, count(*) AS n FROM flags GROUP BY ALL),
each AS (
    SELECT part, filter_order, step, k, n, good, toxic, f[k] AS fails, len(list_filter(earlier, lambda i: f[i])) > 0 AS gone,
           len(list_filter(f, lambda x: x)) = 1 AS alone
    FROM grouped, steps
), counted AS (
    SELECT part, filter_order, step, k,
           coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
           coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails AND alone), 0) AS unique_fails,
           coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
    FROM each GROUP BY part, filter_order, step, k
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": _DECONTAMINATION, "op12_resampling": _RESAMPLING, "op13_filter_audit": _AUDIT}
