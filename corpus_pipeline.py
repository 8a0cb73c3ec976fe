"""The corpus pipeline: documents through five stages, each written and read again.

1. language: documents whose language the byte network rejects go (no letters, or no language
   likely).
2. copies: of documents that the n-gram join links, the one with the smallest doc_id stays.
3. benchmark: documents that repeat a benchmark item, also with other numbers or names, go.
4. personal: personal data get surrogates; n_chars follows the text.
5. mix: sources are mixed to their target weights. One row for each time a document is read,
   with `pass`, `words` (of its text, from the front) and `position`, sorted by position.

Null texts and empty ones go in stage 1. Documents without a doc_id stay in stage 2 unless they
go for another reason. An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.decontaminate import clean
from starloom.llm.language import fit, held_out, keep_known
from starloom.llm.mixing import training_set
from starloom.llm.ngram_join import one_per_component
from starloom.llm.registry import prepare, table
from starloom.llm.surrogates import replaced
from starloom.session import remove_scratch, scratch_made, scratch_path

_earlier: set[str] = set()


def staged(stage):
    """A stage that first removes what the stage before it left in the shared folder.

    Its documents are the written result of that stage, so nothing reads that any more.
    """
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        remove_scratch(spark, _earlier)
        with scratch_made() as made:
            result = stage(spark, docs, sf_dir)
        _earlier.clear()
        _earlier.update(made)
        return result

    return run_stage


@staged
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return keep_known(docs, model)


@staged
def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_component(docs)


@staged
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


@staged
def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = replaced(docs)
    size = F.when(F.col("n_entities") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", size).select(*docs.columns)


@staged
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return training_set(docs)


STAGES = [
    ("language", language),
    ("copies", copies),
    ("benchmark", benchmark),
    ("personal", personal),
    ("mix", mix),
]

# SQL expresses neither the network nor the templates; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
