"""op2: every page to a legacy archive, from there to WARC, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.warc import archived

SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS head FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31), 1)
        FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM h
"""


@query("op2_warc_from_arc", SQL)
def op2_warc_from_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
