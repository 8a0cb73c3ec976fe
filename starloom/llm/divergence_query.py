"""op11: the sources of each language, against each other and against the language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.divergence import LEAST, PRIOR, SCALE, TOP, audited
from starloom.llm.registry import query, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (
    SELECT r, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST}
), kinds AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL
), dense AS (
    SELECT lang, source, term, coalesce(c, 0) AS c, sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS n,
        sum(coalesce(c, 0)) OVER (PARTITION BY lang, term) AS all_c, sum(coalesce(c, 0)) OVER (PARTITION BY lang) AS all_n
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, c,
        (1 + {SCALE}::HUGEINT * (c + {PRIOR}) // (n + {PRIOR} * v))::BIGINT AS p,
        (1 + {SCALE}::HUGEINT * (all_c + {PRIOR}) // (all_n + {PRIOR} * v))::BIGINT AS q
    FROM dense JOIN kinds USING (lang)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {TOP}
"""


@query("op11_source_divergence", SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))
