"""op4: the pseudo-likelihood of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.masked_lm import fit, scored
from starloom.llm.registry import query, table


@query("op4_masked_pseudo_likelihood")
def op4_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs))
