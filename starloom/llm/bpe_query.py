"""op13: every document encoded and decoded again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.bpe import decoded, encoded, vocabulary
from starloom.llm.registry import query, table


@query("op13_bpe_segment_tree")
def op13_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = docs.select("doc_id", encoded(F.col("text"), words).alias("ids"))
    done = done.withColumn("decoded", decoded(F.col("ids"), words))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
