"""op9: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.language import fit, held_out, predicted
from starloom.llm.registry import query, table


@query("op9_language_byte_cnn")
def op9_language_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs.where(~F.col("held_out")).select("text", "lang"))
    return predicted(docs, model, ["doc_id", "held_out"])
