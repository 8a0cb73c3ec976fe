"""op6: all documents, joined on their word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.ngram_join import linked
from starloom.llm.registry import query, table


@query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))
