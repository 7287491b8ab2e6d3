"""SQL statements of the training-data queries that SQL can express."""

from __future__ import annotations

BLANK = r"[\x20\x09-\x0D]+"

OP2 = f"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANK}', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM texts
"""

#: Shingles of documents are made for each width that items have, 5 words or a shorter item's own length.
OP3 = f"""
WITH folded AS (
    SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS n, coalesce(text, '') AS body FROM documents
    UNION ALL
    SELECT 'i', item_id, row_number() OVER (), coalesce(text, '') FROM benchmark
), worded AS (
    SELECT side, id, n, list_filter(
        string_split_regex(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BLANK}'),
        lambda w: w <> '') AS words
    FROM folded
), items AS (
    SELECT id, n, least(5, len(words)) AS width, words FROM worded WHERE side = 'i' AND len(words) > 0
), item_shingles AS (
    SELECT DISTINCT id, n, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS shingle
    FROM items
), sizes AS (
    SELECT n, count(*) AS size FROM item_shingles GROUP BY n
), doc_shingles AS (
    SELECT DISTINCT id, n, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS shingle
    FROM worded, (SELECT DISTINCT width FROM items) WHERE side = 'd'
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(s.size) AS item_shingles, count(*) AS shared_shingles
FROM doc_shingles d JOIN item_shingles i USING (width, shingle) JOIN sizes s ON s.n = i.n
GROUP BY d.id, d.n, i.id, i.n
HAVING 100 * count(*) >= 75 * any_value(s.size)
"""

_CONTROL = "### [A-Za-z0-9_%]*:|</turn>"

OP9 = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), formatted AS (
    SELECT *, '### ' || CASE WHEN regexp_full_match(role, '[a-z]+') THEN upper(role[1]) || role[2:]
                             ELSE '_' || regexp_replace(role, '[^A-Za-z0-9_]', '%20', 'g') END
           || ': ' || regexp_replace(text, '(\\*)({_CONTROL})', '\1\1\\\2', 'g') || ' </turn>' || chr(10) AS formatted
    FROM said
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, formatted)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM formatted
GROUP BY conv_id
"""

#: CRC-32 of each distinct word and run by its bytes; a byte's step is looked up in a table of 256.
OP11 = r"""
WITH steps AS MATERIALIZED (
    SELECT list(list_reduce(list_prepend(n, range(8)),
                            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS step
    FROM (SELECT unnest(range(256)) AS n)
), texts AS (
    SELECT 'd' AS side, row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
), worded AS MATERIALIZED (
    SELECT side, n, doc_id, regexp_extract_all(
        translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
), features AS MATERIALIZED (
    SELECT side, n, unnest(flatten(list_transform([1, 2, 3], lambda k:
        list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))))) AS feature
    FROM worded
), hashed AS MATERIALIZED (
    SELECT feature, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(0, len(digits), 2), lambda i: ('0x' || digits[i + 1:i + 2])::BIGINT)),
        lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT feature, hex(encode(feature)) AS digits FROM (SELECT DISTINCT feature FROM features)), steps
), counted AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
    FROM features JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((sum(s) OVER ()) + 10000)
                                        / ((s + 1.0::DOUBLE) * ((sum(t) OVER ()) + 10000)))) AS BIGINT) AS gain
    FROM counted
), weights AS (
    SELECT n, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
    FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY n
), scored AS (
    SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM worded LEFT JOIN weights USING (n) WHERE side = 'd'
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
           5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank
FROM ordered
"""


def oracle_statements() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op3_decontaminate": OP3, "op9_chat_format": OP9, "op11_importance_resampling": OP11}
