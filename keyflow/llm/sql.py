"""Comparison SQL, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

# CRC-32 of the bytes of ``word``: the table of 256 numbers is worked out by its rule, then the bytes are folded.
_CRC = """
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END)) AS crc
),
crcs AS (
    SELECT word, xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(0, length(h), 2), lambda i:
            (strpos('0123456789ABCDEF', h[i + 1]) * 16 + strpos('0123456789ABCDEF', h[i + 2]) - 17)::UBIGINT)),
        lambda c, b: xor(crc[(xor(c, b) & 255)::BIGINT + 1], c >> 8))) % 10000 AS bucket
    FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words)), crc_table
)"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWERED.format("coalesce(text, '')"))

RESAMPLING = f"""
WITH doc_lists AS (SELECT doc_id, {_WORDS} AS words FROM documents),
doc_words AS (SELECT doc_id, unnest(words) AS word FROM doc_lists),
item_words AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
{_CRC},
source AS (SELECT bucket, count(*) AS n FROM doc_words JOIN crcs USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM item_words JOIN crcs USING (word) GROUP BY bucket),
gains AS (
    SELECT source.bucket, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM source) + 10000)
        / ((source.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM target) + 10000))))::BIGINT AS gain
    FROM source LEFT JOIN target USING (bucket)
),
weights AS (
    SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM doc_words JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
    SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM doc_lists LEFT JOIN weights USING (doc_id)
),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
    QUALIFY rank <= 10 * count(*) OVER () // 100
)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
"""

_INNER = "list_sum(list_transform(range(1, 1 + len(a.v)), lambda i: a.v[i] * b.v[i]))::BIGINT"

NEGATIVES = f"""
WITH items AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, {_INNER} AS score
    FROM items a JOIN items b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
ranked AS (
    SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
