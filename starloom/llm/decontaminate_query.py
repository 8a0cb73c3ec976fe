"""op1: documents that repeat benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.decontaminate import repeats
from starloom.llm.registry import query, table


@query("op1_decontaminate_templates")
def op1_decontaminate_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "covered", "coverage", "changed_slots")
