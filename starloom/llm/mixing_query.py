"""op3: all documents mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.mixing import SCHEDULES, by_position, placed
from starloom.llm.registry import query, table


def _moment_sql() -> str:
    """The moment of demand `q` under the schedule of `rank`, from the schedules' own numbers."""
    from starloom.llm.mixing import _segments

    cases = []
    for k, knots in enumerate(SCHEDULES):
        parts = _segments(knots)
        lines = []
        for n, (t0, w0, slope, before, _) in enumerate(parts):
            rest = f"greatest(q - {before!r}::DOUBLE, 0::DOUBLE)"
            root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {rest}, 0::DOUBLE))"
            at = f"{t0!r}::DOUBLE + CASE WHEN {rest} > 0 THEN 2::DOUBLE * {rest} / ({w0!r}::DOUBLE + {root}) ELSE 0 END"
            until = f"WHEN q < {parts[n + 1][3]!r}::DOUBLE THEN" if n + 1 < len(parts) else "ELSE"
            lines.append(f"{until} {at}")
        inner = " ".join(lines)
        inner = f"CASE {inner} END" if len(parts) > 1 else inner.removeprefix("ELSE ")
        cases.append(f"WHEN rank % {len(SCHEDULES)} = {k} THEN {inner}")
    return f"CASE {' '.join(cases)} END"


SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('mix:' || doc_id) AS key
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(rank % 3 + 1)::INT] AS weight, sum(source_size) OVER ()::BIGINT AS total FROM sums
), steps AS (
    SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
        sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, rank)::BIGINT AS capped,
        sum(weight) OVER ()::BIGINT
            - sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, rank)::BIGINT AS open_weight
    FROM weighed
), levels AS (
    SELECT 1.5::DOUBLE * max(total) / sum(weight) AS level, 0::DOUBLE AS above FROM weighed
    UNION ALL
    SELECT (1.5::DOUBLE * total - 2.0::DOUBLE * capped) / open_weight, ratio FROM steps WHERE open_weight > 0
), goal AS (
    SELECT source, source_size, rank,
        least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels WHERE level >= above) * weight) AS target
    FROM weighed
), rows AS (
    SELECT doc_id, size, source_size, rank, target, floor(target + 0.5)::BIGINT AS quota,
        (sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
            ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
    FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source
), takes AS (
    SELECT *, greatest(0, least(size, quota - start))::BIGINT AS first,
        greatest(0, least(size, quota - start - source_size))::BIGINT AS second
    FROM rows
), placed AS (
    SELECT *, (start + first / 2::DOUBLE) / quota AS q FROM takes
)
SELECT doc_id, size, source_size, target, (first + second)::BIGINT AS taken,
    CASE WHEN first > 0 THEN {_moment_sql()} END AS position
FROM placed
"""


@query("op3_mix_curriculum", SQL)
def op3_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = placed(table(spark, sf_dir, "documents"))
    first = F.get("passes", F.lit(0))["position"].alias("position")
    return by_position(rows.select("doc_id", "size", "source_size", "target", "taken", first))
