"""DuckDB SQL that the queries of this package must agree with, where SQL can express them."""

from __future__ import annotations

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

HITS = f"""
WITH items AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM benchmark),
grams AS (
    SELECT DISTINCT item, least(len(words), 10) AS length,
        unnest([array_to_string(words[i + 1:i + 10], ' ') FOR i IN range(greatest(len(words) - 10, 0) + 1)]) AS gram
    FROM items WHERE len(words) > 0),
texts AS (
    SELECT row_number() OVER () AS doc_row, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents),
windows AS (
    SELECT doc_row, length, start, array_to_string(words[start + 1:start + length], ' ') AS gram
    FROM (SELECT doc_row, words, length, unnest(range(len(words) - length + 1)) AS start
          FROM texts, (SELECT DISTINCT length FROM grams) WHERE len(words) >= length)),
found AS (SELECT doc_row, start, length, item FROM windows JOIN grams USING (length, gram)),
hit AS (SELECT doc_row, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_row, unnest(range(start, start + length)) AS place FROM found) GROUP BY doc_row),
named AS (SELECT doc_row, list(DISTINCT item ORDER BY item) FILTER (item IS NOT NULL) AS items FROM found GROUP BY doc_row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_row) LEFT JOIN named USING (doc_row)
"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

SHARDS = f"""
WITH crc_table AS (
    SELECT list(crc ORDER BY byte) AS crcs FROM (
        SELECT byte, list_reduce([byte::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: {_CRC_STEP}) AS crc
        FROM range(256) r(byte))),
bytes AS (
    SELECT doc_id, source, md5(text) AS digest, coalesce(strlen(text), 0) + 16 AS size,
        list_prepend(4294967295::BIGINT, [('0x' || hex(text)[2 * i + 1:2 * i + 2])::BIGINT
            FOR i IN range(coalesce(strlen(text), 0))]) AS steps
    FROM documents),
keyed AS (
    SELECT doc_id, size,
        xor(list_reduce(steps, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
        coalesce('=' || source, '~') AS skey,
        md5('shard|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(digest), '')) AS key
    FROM bytes, crc_table),
ranked AS (
    SELECT *, 2 * row_number() OVER (PARTITION BY skey ORDER BY key) - 1 AS odd,
        count(*) OVER (PARTITION BY skey) AS rows_of, count(*) OVER () AS total
    FROM keyed),
placed AS (
    SELECT *, row_number() OVER (ORDER BY odd::DOUBLE / (2 * rows_of)::DOUBLE, skey, key) - 1 AS place FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 40 // total)::INTEGER AS shard,
    place - ((place * 40 // total) * total + 39) // 40 AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

_SIZED = """
sized AS (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
        coalesce('=' || source, '~') AS skey,
        md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')) AS key
    FROM documents),
sources AS (SELECT skey, sum(size)::BIGINT AS source_size FROM sized GROUP BY skey),
weighed AS (
    SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY skey) - 1) % 3 + 1]::DOUBLE AS weight,
        (source_size * 2)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
    FROM sources),
levels AS (
    SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed),
targets AS (
    SELECT *, least(cap, (SELECT max(level) FROM levels WHERE level <= cap / weight) * weight) AS target FROM levels),
passes AS (
    SELECT s.*, source_size, target, budget, p,
        (sum(size) OVER (PARTITION BY s.skey, p ORDER BY key ROWS UNBOUNDED PRECEDING) + source_size * p)::DOUBLE / target AS finish
    FROM sized s JOIN targets USING (skey), range(2) r(p)),
queue AS (
    SELECT *, sum(size) OVER (ORDER BY finish, skey, key, p ROWS UNBOUNDED PRECEDING) <= budget AS taken FROM passes)
"""

MIX = f"""
WITH {_SIZED}
SELECT doc_id, size, source_size, any_value(target) AS target, (size * count(*) FILTER (taken))::BIGINT AS taken
FROM queue GROUP BY doc_id, key, size, source_size
"""

_FIVE = "('0x' || digest[5 * i + 1:5 * i + 5])::INTEGER"
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_FIVE} >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0))

CAPTURES = f"""
WITH pages_of AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
largest AS (SELECT *, max(page_id) OVER (PARTITION BY digest, payload_bytes) AS response FROM pages_of)
SELECT page_id, payload_bytes, array_to_string([{_BASE32} FOR i IN range(8)], '') AS payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM largest
"""

NEAREST = """
WITH vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_prepend(0.0::DOUBLE, [(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) FOR i IN range(1, len(q.v) + 1)]),
        lambda s, x: s + x)) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_CLUSTER_ROUNDS = 10
_DISTANCE = "list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, 65)])::BIGINT"


def _assigned(round: int) -> str:
    return f"""assigned{round} AS MATERIALIZED (
    SELECT row, first(k ORDER BY d, k) AS k, min(d) AS d
    FROM (SELECT row, k, {_DISTANCE} AS d FROM kept, centroids{round}) GROUP BY row)"""


def _centroids(round: int) -> str:
    return f"""centroids{round} AS MATERIALIZED (
    SELECT k, coalesce(m.c, old.c) AS c FROM centroids{round - 1} old LEFT JOIN (
        SELECT k, list(mean ORDER BY i) AS c FROM (
            SELECT k, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
            FROM assigned{round - 1} JOIN kept USING (row), range(1, 65) r(i) GROUP BY k, i) GROUP BY k) m USING (k))"""


CLUSTERS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v)::INTEGER - 1 AS k, v AS c
    FROM kept ORDER BY k LIMIT 8),
{", ".join(f"{_assigned(i)}, {_centroids(i + 1)}" for i in range(_CLUSTER_ROUNDS))},
{_assigned(_CLUSTER_ROUNDS)}
SELECT vec_id, k AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM assigned{_CLUSTER_ROUNDS} JOIN kept USING (row) JOIN centroids{_CLUSTER_ROUNDS} USING (k)
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, m, unnest([array_to_string(w[i + 1:i + m], ' ') FOR i IN range(len(w) - m + 1)]) AS phrase
    FROM words, range(1, 4) r(m) WHERE len(w) >= m),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 10),
around AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE m = 3)
    GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 50::HUGEINT * a),
cuts AS (
    SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
    JOIN counts l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
