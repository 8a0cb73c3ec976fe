"""Hot keys beside the buckets: which keys, what the join moves, how much a task reads."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.operators.hot_keys import hot_hashes, join_split, shared_hot, split_table
from tests.test_layout_plans import tiny_partitions  # noqa: F401

N = 60_000


def skewed(spark):
    """A third of the rows have key 7; key 8 has a tenth; the others are spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).otherwise(F.col("id") % 5000 + 100)
    return spark.range(0, N, 1, 8).select(key.cast("bigint").alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x"))


def test_hot_keys_are_those_above_the_share(spark):
    rng = random.Random(1)
    for seed in range(3):
        keys = [rng.choice([0] * 50 + [1] * 20 + list(range(2, 400))) for _ in range(3000)]
        df = spark.createDataFrame([(k, "x") for k in keys], "k bigint, v string").repartition(7)
        hashes = {r.h: r.k for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
        for share in (0.02, 0.1, 0.5):
            got = {hashes[h]: n for h, n in hot_hashes(df, ["k"], share).items()}
            assert got == {k: keys.count(k) for k in set(keys) if keys.count(k) >= share * len(keys)}
    assert hot_hashes(df.limit(0), ["k"], 0.1) == {}
    with pytest.raises(ValueError):
        hot_hashes(df, ["k"], 0)


def split_both(spark, tmp_path, left, right, share=0.05):
    hot = shared_hot([(left, ["k"]), (right, ["r"])], share)
    run = uuid.uuid4().hex
    a = split_table(left, f"a_{run}", f"{tmp_path}/a", ["k"], ["id"], 8, hot)
    return a, split_table(right, f"b_{run}", f"{tmp_path}/b", ["r"], ["r"], 8, hot)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_the_join_is_that_of_the_whole_tables(spark, tmp_path, how):
    left = skewed(spark).where("id < 6000").unionByName(
        spark.createDataFrame([(None, 1, "n"), (-5, 2, "none")], "k bigint, id bigint, x string"))
    right = spark.range(0, 6000).where("id <> 300").select(F.col("id").alias("r"), (F.col("id") * 2).alias("y"))
    right = right.unionByName(spark.createDataFrame([(7, 0), (None, 1)], "r bigint, y bigint"))
    a, b = split_both(spark, tmp_path, left, right)
    assert len(a.hot) == 2
    want = left.join(right, left.k == right.r, how)
    for limit in (1 << 20, 0):
        assert rows_of(join_split(spark, a, b, how, limit)) == rows_of(want)
    assert rows_of(a.rows(spark)) == rows_of(left)


def test_buckets_are_not_moved_and_tasks_are_even(spark, tmp_path, tiny_partitions):  # noqa: F811
    left = skewed(spark)
    right = spark.range(0, 6000).select(F.col("id").alias("r"))
    a, b = split_both(spark, tmp_path, left, right)
    joined = join_split(spark, a, b)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    cold = plan[plan.index("SortMergeJoin"):plan.index("BroadcastHashJoin")]
    assert "Exchange" not in cold and "SelectedBucketsCount" in cold
    reads = [
        df.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0]
        for df in (a.buckets(spark), a.hot_rows(spark))]
    assert max(reads) < N / 6  # a third of the rows would be N / 3
    assert joined.count() == N


def test_tables_split_by_other_keys_do_not_join(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1)], "k bigint, id bigint")
    a = split_table(rows, f"a_{uuid.uuid4().hex}", f"{tmp_path}/a", ["k"], ["id"], 2, [5])
    b = split_table(rows, f"b_{uuid.uuid4().hex}", f"{tmp_path}/b", ["k"], ["id"], 2, [])
    with pytest.raises(ValueError):
        join_split(spark, a, b)
