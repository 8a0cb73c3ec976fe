"""Physical layout: distribution, sorting, bucketing, replication, caching.

Rows are brought together by a rebalance, not by a plain repartition: AQE splits a partition
that one hot key makes too large and joins small ones, so file sizes are even whatever the
distribution of the key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Size up to which a table may be copied to every executor.
REPLICATE_BYTES = 64 * 1024 * 1024

# A key is hot if one of so many buckets has so many times the rows of the mean bucket.
HOT_BUCKETS, HOT_SHARE = 1024, 8.0


def distribute_sort(df: DataFrame, key: list[str], sort: list[str]) -> DataFrame:
    """Rows of a key next to each other, sorted within files."""
    return df.hint("rebalance", *key).sortWithinPartitions(*sort)


def distribute_merged(
    df: DataFrame, key: list[str], sort: list[str], merged: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`distribute_sort` of `merged(df)`, where `merged` groups by columns that include `key`.

    Unless a key is hot, the rows are distributed before they are merged, so that they are
    shuffled once. Those of a hot key are merged first, on the map side and over all columns
    of the grouping, and distributed then.
    """
    if largest_bucket_share(df, key, HOT_BUCKETS) > HOT_SHARE:
        return distribute_sort(merged(df), key, sort)
    return merged(df.hint("rebalance", *key)).sortWithinPartitions(*sort)


def repartition_by_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Few files per partition value in a partitioned write."""
    return df.hint("rebalance", *columns)


def read_in_order(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows sorted by key and clustering columns over range partitions of both, so that a hot
    key spreads over several tasks."""
    return df.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of a result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Size of the values of a result, by one aggregate."""
    widths = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = F.octet_length(column)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            width = F.octet_length(F.to_json(F.struct(column)))
        else:
            width = F.lit(8)
        widths.append(F.coalesce(width, F.lit(0)).cast("bigint"))
    total = df.agg(F.sum(reduce(Column.__add__, widths)).alias("b")).first().b
    return int(total or 0)


def replicate(df: DataFrame, limit: int = REPLICATE_BYTES) -> DataFrame:
    """Mark a dimension for copying to every executor if its measured size is within the limit.

    A table that Spark already estimates as larger is not measured. A larger one is left to a
    shuffle join.
    """
    small = estimated_bytes(df) <= limit and measured_bytes(df) <= limit
    return F.broadcast(df) if small else df


def cached(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Persist only the needed columns of a source that several outputs read."""
    kept = df.select(*columns) if columns else df
    return kept.persist(StorageLevel.MEMORY_AND_DISK)


def largest_bucket_share(df: DataFrame, keys: list[str], buckets: int) -> float:
    """Rows of the fullest bucket relative to the mean, from one count per bucket."""
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    row = sizes.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
    return 0.0 if not row.total else row.largest * buckets / row.total


def bucket_table(
    df: DataFrame, table: str, path: str, keys: list[str], sort: list[str], buckets: int
) -> None:
    """Save as a bucketed table for joins without a shuffle.

    One task writes one bucket, and one joins it later: `largest_bucket_share` tells before
    whether a hot key makes a bucket too large. `hot_keys.split_table` is the layout for such a
    key, or `distribute_sort`, whose joins shuffle and are split by AQE.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys)
    (writer.sortBy(*sort) if sort else writer).saveAsTable(table)
