"""Incremental loads: each run takes the files it has not seen and appends them exactly once.

A file stream with `availableNow` replaces the scheduled restaging of the whole log. The
stream's checkpoint remembers the files; the keyed append makes a repeated micro-batch harmless.
Each batch is written once to the shared folder, so nothing is parsed twice, also after an
executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.contracts import TableContract
from starloom.operators.tables import MICROS, append_fact, beside, drop_table, exists
from starloom.session import kept


def file_stream(
    spark: SparkSession, path: str, contract: TableContract, fmt: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder; with format "text", their lines in column `value`, and `_metadata`."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if fmt != "text":
        reader = reader.schema(contract.schema).option("timestampNTZFormat", MICROS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.format(fmt).load(path)
    return rows.select("value", F.col("_metadata").alias("_metadata")) if fmt == "text" else rows


def run_batches(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]
) -> None:
    """Process everything that is new, then stop."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_incremental(
    spark: SparkSession,
    source: str,
    contract: TableContract,
    fact: str,
    checkpoint: str,
    key: list[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | tuple[str, ...] = (),
    refresh: Callable[[DataFrame], None] | None = None,
    collect: Callable[[DataFrame], DataFrame] | None = None,
    before: Callable[[DataFrame], None] | None = None,
    stage: Callable[[DataFrame, int], DataFrame] | None = None,
    fmt: str = "json",
    files_per_batch: int | None = None,
    always: bool = False,
    conflicts: str | None = None,
    laid_out: bool = False,
    late: Callable[[DataFrame], DataFrame] | None = None,
    hashed: list[str | Column] | None = None,
    numbered: str | None = None,
) -> None:
    """Append new source files to the fact, then refresh the dimensions once.

    `stage` turns the raw batch of a number into rows. `collect` takes what the refresh needs from a batch,
    e.g. the newest row of each key; it is stored under the number of the batch, so that a
    repeated batch replaces its own rows. After the last batch `refresh` gets all of them at
    once. A run that stops before leaves them to the next run; with `always`, a run without new
    files calls it with None. `before` gets the fact rows of a batch before they are appended and
    may raise. Different rows of one key stop the run, or go to `conflicts` by batch. With `laid_out`
    the rows of `transform` are what is written once: beside the fact and in its layout, with what
    `late` adds to them after they have been moved, and `collect` gets them. If no key comes again,
    known by what is `hashed`, these files become the fact's. `numbered` names a column for the
    number of the batch, in the fact and in what `refresh` gets.
    """
    pending = f"{checkpoint.rstrip('/')}-pending"

    def take(rows: DataFrame, number: int) -> None:
        if refresh is not None:
            taken = collect(rows) if collect else rows
            taken.write.mode("overwrite").parquet(f"{pending}/batch={number}")

    def append(rows: DataFrame, number: int, **options) -> None:
        append_fact(rows, fact, key, partition_by, hashed=hashed,
                    conflicts=f"{conflicts}/batch={number}" if conflicts else None, **options)

    def shaped(rows: DataFrame, number: int) -> DataFrame:
        rows = transform(rows) if transform else rows
        return rows.withColumn(numbered, F.lit(number).cast("bigint")) if numbered else rows

    def on_batch(batch: DataFrame, number: int) -> None:
        rows = stage(batch, number) if stage else batch
        if laid_out:
            with beside(shaped(rows, number), fact, partition_by, late) as (stored, folder):
                def pass_on(checked: DataFrame) -> None:
                    if before is not None:
                        before(checked)
                    take(stored, number)

                append(stored, number, before=pass_on, stored=True, ready=folder)
            return
        with kept(rows, "micro-batch") as rows:
            append(shaped(rows, number), number, before=before, stored=transform is None)
            take(rows, number)

    run_batches(file_stream(spark, source, contract, fmt, files_per_batch), checkpoint, on_batch)
    if refresh is not None and exists(spark, pending):
        left = spark.read.parquet(pending)
        refresh(left.withColumnRenamed("batch", numbered) if numbered else left.drop("batch"))
        drop_table(spark, pending)
    elif refresh is not None and always:
        refresh(None)
