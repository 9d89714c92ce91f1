"""The queries that SQL can express, for DuckDB, to check results against."""

from __future__ import annotations

#: White space of lines and words: space, and tab to carriage return.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(range(len(all_lines))) AS place, unnest(all_lines) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (keeper IS NULL OR keeper = doc_id), ''))
           AS kept_sha256
FROM keyed LEFT JOIN common USING (key)
GROUP BY doc_id
"""

PHRASES = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(words) - 48)) AS place,
           unnest([sha256(array_to_string(words[i:i + 49], ' ')) for i in range(1, len(words) - 48)]) AS passage
    FROM split WHERE len(words) >= 50
), earliest AS (
    SELECT doc_id, place, min(doc_id) OVER (PARTITION BY passage) < doc_id AS repeats FROM windows
), each AS (
    SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM split
), covered AS (
    SELECT each.doc_id, each.place, word, coalesce(max(repeats) OVER (
               PARTITION BY each.doc_id ORDER BY each.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
    FROM each LEFT JOIN earliest ON each.doc_id = earliest.doc_id AND each.place = earliest.place
)
SELECT split.doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM split LEFT JOIN covered ON split.doc_id = covered.doc_id
GROUP BY split.doc_id
"""

#: CRC-32 of a decimal id, bit by bit: the polynomial 0xEDB88320, all ones before and after.
_CRC = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(conv_id::VARCHAR, '')]),
        lambda state, byte: list_reduce(
            list_prepend(xor(state, byte), range(8)),
            lambda bits, i: xor(bits >> 1, 3988292384 * (bits & 1)))))
"""

TRIE = f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
    SELECT ids.conv_id, own.place, role, text FROM ids JOIN own ON own.conv_id = base AND own.place <= h
    UNION ALL
    SELECT ids.conv_id, own.place, role, text FROM ids JOIN own ON own.conv_id = ids.conv_id AND own.place > h
), turns AS (
    SELECT conv_id, strlen(text) AS size, len(role) || ':' || role || text AS turn,
           row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth
    FROM rebuilt
), paths AS (
    SELECT conv_id, depth, size,
           sha256(string_agg(sha256(turn), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
    FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), steps AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
    FROM paths
), nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id,
           count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM steps GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
), below AS (
    SELECT steps.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum(c.saved)::BIGINT AS saved_tokens
    FROM counted c JOIN steps ON steps.conv_id = c.conv_id AND steps.depth <= c.depth
    GROUP BY steps.node
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN below USING (node) LEFT JOIN nodes p ON p.node = c.parent
"""


CONTAINED = r"""
WITH items AS (
    SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
    FROM benchmark
), texts AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words
    FROM documents
), item_grams AS (
    SELECT DISTINCT item_id, unnest(if(len(words) < 5, [array_to_string(words, ' ')],
           [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)])) AS gram
    FROM items WHERE len(words) > 0
), lengths AS (
    SELECT 5 AS n UNION SELECT len(words) FROM items WHERE len(words) BETWEEN 1 AND 4
), doc_grams AS (
    SELECT DISTINCT doc_id, unnest([array_to_string(words[i:i + n - 1], ' ') for i in range(1, len(words) - n + 2)]) AS gram
    FROM texts, lengths WHERE len(words) >= n
    UNION
    SELECT doc_id, array_to_string(words, ' ') FROM texts WHERE len(words) BETWEEN 1 AND 4
), sizes AS (
    SELECT item_id, count(*) AS n_item FROM item_grams GROUP BY item_id
)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM doc_grams JOIN item_grams USING (gram) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": LINES, "op4_contamination": CONTAINED, "op6_phrases": PHRASES, "op12_prefix_trie": TRIE}
