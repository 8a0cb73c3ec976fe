"""op8: the severity of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.toxicity import fit, scored


@query("op8_toxicity_severity")
def op8_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))
