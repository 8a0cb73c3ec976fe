"""op5: all documents with surrogates for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.surrogates import replaced


@query("op5_pii_surrogates")
def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))
