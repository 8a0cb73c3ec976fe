"""op12: the prefix trie of all conversations, each rebuilt with its family's first turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.prefix_trie import FAMILY, HEADS, trie
from starloom.llm.registry import query, table

# The polynomial of crc32, bit by bit over the digits of an id.
SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, digest, length(text) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos
    FROM turns
), convs AS (
    SELECT conv_id, conv_id - conv_id % {FAMILY} AS head, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: unicode(d)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
            lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % {HEADS} AS h
    FROM (SELECT DISTINCT conv_id FROM own)
), sized AS (
    SELECT c.*, least(h, (SELECT count(*) FROM own WHERE own.conv_id = c.head)) AS taken FROM convs c
), steps AS (
    SELECT s.conv_id, o.pos, digest, chars FROM sized s JOIN own o ON o.conv_id = s.head AND o.pos <= taken
    UNION ALL
    SELECT conv_id, pos - h + taken, digest, chars FROM sized JOIN own USING (conv_id) WHERE pos > h
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
), paths AS (
    SELECT conv_id, pos, chars, sha256(string_agg(digest, '') OVER w) AS p,
        max(pos) OVER (PARTITION BY conv_id) AS depth
    FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), nodes AS (
    SELECT pos, p, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = pos), '') AS ends
    FROM paths GROUP BY pos, p
), linked AS (
    SELECT n.*, u.conv_id AS parent FROM nodes n
    LEFT JOIN paths q ON q.conv_id = n.conv_id AND q.pos = n.pos - 1
    LEFT JOIN nodes u ON u.pos = q.pos AND u.p = q.p
), grown AS (
    SELECT l.*, (SELECT count(*) FROM linked k WHERE k.parent = l.conv_id AND k.pos = l.pos + 1) AS children
    FROM linked l
), sums AS (
    SELECT q.pos, q.p, sum((g.n - 1) * g.chars) AS saved, count(*) FILTER (WHERE g.children = 0) AS leaves
    FROM grown g JOIN paths q ON q.conv_id = g.conv_id AND q.pos <= g.pos GROUP BY q.pos, q.p
)
SELECT conv_id, pos::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, children AS n_children,
    leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM grown JOIN sums USING (pos, p)
"""


@query("op12_conversation_trie", SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
