"""op10: fingerprints of every document and of its edited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.sketch import edited_fingerprints


@query("op10_scaled_sketch")
def op10_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
