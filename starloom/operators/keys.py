"""Surrogate keys, and exact running totals over a total order.

A global window would sort the table in one task. Here the rows are range-partitioned by the
order, each partition numbers its own rows, and the partition sizes (one row per partition)
give the offsets. The rows are written once before that, so that the plan above them runs once
and the number of partitions follows from their size, and once after it, because range bounds
are sampled anew by every execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starloom.functions.text import as_text, md5_key
from starloom.session import kept, scratch_path, stored_bytes, written

PART, POS, COPIES, BEFORE = "_part", "_pos", "_copies", "_before"
# Rows one task emits when it unfolds the copies of one row.
UNFOLD = 1_000_000


# Stored bytes of a range partition.
RANGE_BYTES = 8 * 1024 * 1024


def _partitions(spark: SparkSession, path: str) -> int:
    """As many as the session's own number, or more for a large table."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-stored_bytes(spark, path) // RANGE_BYTES))


def _offsets(sizes: DataFrame) -> DataFrame:
    """(part, size) of every partition to (part, sum of the earlier sizes).

    There is one row per shuffle partition, whatever the size of the data, so the driver adds
    them up and every executor gets a copy.
    """
    rows, total = [], 0
    for part, size in sorted((r[0], r[1]) for r in sizes.collect()):
        rows.append((part, total))
        total += size
    offsets = sizes.sparkSession.createDataFrame(rows, f"{PART} int, _offset bigint")
    return F.broadcast(offsets)


def _ranged(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "unranged")
    with kept(df, "unranged", path) as rows:
        n = partitions or _partitions(spark, path)
        return written(
            rows.repartitionByRange(n, *order)
            .sortWithinPartitions(*order)
            .withColumn(PART, F.spark_partition_id())
            .withColumn(POS, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
            "ranged",
        )


def running_total(
    df: DataFrame, order: list[Column], weight: str, partitions: int | None = None
) -> DataFrame:
    """Add `_before`: the sum of the weights of all rows before this one. `order` is unique."""
    saved = _ranged(df, order, partitions)
    offsets = _offsets(saved.groupBy(PART).agg(F.sum(weight)))
    # One range partition per window group: evenly sized, as they were cut by row count.
    inside = F.sum(weight).over(
        Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        saved.withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(offsets, PART)
        .withColumn(BEFORE, F.col("_inside") + F.col("_offset"))
        .drop(PART, POS, "_inside", "_offset")
    )


def dense_key(
    df: DataFrame,
    order: list[str | Column],
    name: str = "id",
    start: int = 0,
    unique: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows start, start + 1, ... in the given order.

    Say `unique=False` if the order is not a unique key. Rows are then ordered by all their
    columns after it, and exact copies are counted first and unfolded at the end, so that even
    a large group of copies is never in one task.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    columns = df.columns
    if unique:
        saved = _ranged(df, by, partitions)
        offsets = _offsets(saved.groupBy(PART).agg(F.count("*")))
        number = F.col("_offset") + F.col(POS) + F.lit(start)
        return saved.join(offsets, PART).select(*columns, number.cast("bigint").alias(name))
    counted = df.groupBy(*columns).agg(F.count("*").alias(COPIES))
    placed = running_total(counted, [*by, *[F.col(c) for c in columns]], COPIES, partitions)
    zero, step = F.lit(0).cast("bigint"), F.lit(UNFOLD).cast("bigint")
    chunk = F.explode(F.sequence(zero, F.col(COPIES) - 1, step))
    chunks = placed.withColumn("_chunk", chunk).hint("rebalance")
    last = F.least(F.col("_chunk") + F.lit(UNFOLD), F.col(COPIES)) - 1
    copy = F.explode(F.sequence(F.col("_chunk"), last))
    number = F.col(BEFORE) + F.col("_copy") + F.lit(start)
    return chunks.withColumn("_copy", copy).select(*columns, number.cast("bigint").alias(name))


def monotonic_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, increasing ids with gaps; not the same from run to run."""
    return df.withColumn(name, F.monotonically_increasing_id())


def row_key(df: DataFrame, columns: list[str], name: str = "id") -> DataFrame:
    """md5 of the columns' texts with a bar after each; NULL counts as a text of its own, so that
    every row gets a key and different values different ones."""
    kinds = dict(df.dtypes)
    texts = [
        F.coalesce(
            as_text(F.col(c), "timestamp" if kinds[c].startswith("timestamp") else "string"),
            F.lit("-"))
        for c in columns
    ]
    return df.withColumn(name, F.md5(F.concat_ws("|", *texts)))


def hashed_key(df: DataFrame, columns: list[str], name: str = "id") -> DataFrame:
    """md5 of the columns' texts put together; times as yyyy-MM-dd HH:mm:ss."""
    kinds = dict(df.dtypes)
    texts = [
        as_text(F.col(c), "timestamp" if kinds[c].startswith("timestamp") else "string")
        for c in columns
    ]
    return df.withColumn(name, md5_key(*texts))
