"""Bucketed tables with a place of their own for hot keys.

One task reads one bucket, so a key that holds a third of the rows would make one task read a third
of the table. Here the rows of such keys stand beside the buckets in files of even size. A join of
two tables split alike is the join of the buckets, without a shuffle, and the join of the hot rows,
where a side that is measured as small is copied and a larger one is shuffled and split by AQE.

Hot keys are found with a summary of frequent items: it is filled in one pass, merges across tasks,
holds at most 1 / share items, and misses none above the share; what it names is then counted
exactly. So neither step shuffles all distinct keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.operators.layout import REPLICATE_BYTES, bucket_table, replicate

HASH = "_key_hash"


def hash_of(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def hot_hashes(df: DataFrame, keys: list[str], share: float) -> dict[int, int]:
    """{hash of a key: rows} of the keys with at least `share` of the rows; at most 1 / share."""
    if not 0.0001 <= share <= 1:
        raise ValueError("the share of a hot key must be between 0.0001 and 1")
    hashed = df.select(hash_of(keys).alias(HASH))
    found = hashed.stat.freqItems([HASH], share).first()[0] or []
    counts = hashed.agg(F.count("*").alias("all"), *[
        F.count_if(F.col(HASH) == F.lit(h)).alias(f"n{i}") for i, h in enumerate(found)]).first()
    return {h: counts[f"n{i}"] for i, h in enumerate(found) if counts[f"n{i}"] >= share * counts["all"]}


def shared_hot(tables: list[tuple[DataFrame, list[str]]], share: float) -> list[int]:
    """Hashes that are hot in any of the tables: the split that all of them need for a join."""
    return sorted({h for df, keys in tables for h in hot_hashes(df, keys, share)})


@dataclass(frozen=True)
class SplitTable:
    """A table in buckets of its keys, and the rows of hot keys beside them."""

    table: str
    hot_path: str
    keys: tuple[str, ...]
    hot: tuple[int, ...]

    def buckets(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def hot_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.buckets(spark).schema).parquet(self.hot_path)

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.buckets(spark).unionByName(self.hot_rows(spark))


def split_table(
    df: DataFrame, table: str, path: str, keys: list[str], sort: list[str], buckets: int, hot: list[int],
) -> SplitTable:
    """Save `df` under `path`: rows of the hot keys as files of even size, the others in buckets.

    Tables that are joined need the same keys, buckets and hot hashes.
    """
    is_hot = hash_of(keys).isin(hot) if hot else F.lit(False)
    bucket_table(df.where(~is_hot), table, f"{path}/buckets", keys, sort, buckets)
    # Dealt by all columns, so that a hot key alone does not decide where its rows go.
    (df.where(is_hot).hint("rebalance").sortWithinPartitions(*keys, *sort)
     .write.mode("overwrite").parquet(f"{path}/hot"))
    return SplitTable(table, f"{path}/hot", tuple(keys), tuple(hot))


def join_split(
    spark: SparkSession, left: SplitTable, right: SplitTable, how: str = "inner", limit: int = REPLICATE_BYTES,
) -> DataFrame:
    """Join two split tables on their keys, key by key in order; `how` is inner or left.

    Columns of both sides, so their names must differ. Only rows of hot keys are ever moved.
    """
    if left.hot != right.hot or how not in ("inner", "left"):
        raise ValueError("tables must be split by the same hot keys, and joined by inner or left")

    def on(a: DataFrame, b: DataFrame) -> Column:
        return reduce(Column.__and__, [a[x] == b[y] for x, y in zip(left.keys, right.keys)])

    a, b = left.buckets(spark), right.buckets(spark)
    cold = a.hint("merge").join(b, on(a, b), how)
    x, y = left.hot_rows(spark), replicate(right.hot_rows(spark), limit)
    return cold.unionByName(x.join(y, on(x, y), how))
