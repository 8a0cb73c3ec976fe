"""Physical plans: pushdown, pruning, partial aggregates, joins without a shuffle, hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from starloom.functions.timeparts import on_day, within_years
from starloom.operators import aggregates, layout, merge, quality
from starloom.operators.cleaning import latest_window
from starloom.operators.matching import match_plays
from starloom.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_no_python_worker_in_any_lazy_plan(spark):
    for name in ("q_top_songs", "pipe_play_star_users", "fn_weekday_sun0", "join_code_lookup",
                 "q_top_city_in_month", "fn_sas_date", "filter_valid_code"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "ArrowEval" not in text, name


def test_range_filters_reach_the_scan(spark):
    orders = table(spark, "orders")
    text = plan(orders.where(within_years(F.col("o_orderdate"), 1996, 1998)).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)
    text = plan(table(spark, "events").where(on_day(F.col("ts"), 2024, 1, 21)).select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_latest_window_is_one_column_and_a_filter(spark):
    text = plan(latest_window(table(spark, "events"), "ts").select("event_id"))
    assert "Subquery" in text and "ReadSchema: struct<ts:timestamp_ntz>" in text
    assert "Window" not in text and "Join" not in text


def test_partition_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, "orders").withColumn("year", F.year("o_orderdate"))
    df.write.partitionBy("year").parquet(path)
    text = plan(spark.read.parquet(path).where("year = 1997"))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1997\)\]", text)


def test_argmax_and_counts_are_partial_and_without_a_window(spark):
    orders = table(spark, "orders")
    text = plan(aggregates.rows_at_max(orders, ["o_custkey"], "o_orderdate"))
    assert "partial_max" in text and "Window" not in text
    text = plan(quality.foreign_key(orders, "o_custkey", table(spark, "customer"), "c_custkey"))
    assert "partial_count" in text
    assert text.index("LeftOuter") < text.index("partial_count")  # counted below the join


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            layout.bucket_table(
                table(spark, name), f"plan_{name}", str(tmp_path / name), [key], [key], 4
            )
        joined = spark.table("plan_orders").join(
            spark.table("plan_lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
        )
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tiny_partitions(spark):
    """Thresholds small enough for AQE to see skew in test data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "24KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_plays(spark, n=40_000):
    """A third of the plays are of one song."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("song "), F.col("id") % 500)).alias("song"),
        F.lit("A").alias("artist"), F.lit(1.0).alias("length"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"), "id",
    )


def test_a_hot_song_is_split_in_the_match(spark, tiny_partitions):
    titles = [("hot", "S0")] + [(f"song {i}", f"S{i + 1}") for i in range(500)]
    catalog = spark.createDataFrame(titles, "title string, song_id string").select(
        "title", "song_id", F.lit("A").alias("artist_name"), F.lit("A1").alias("artist_id"),
        F.lit(1.0).alias("duration"),
    )
    matched = match_plays(hot_plays(spark), catalog, pick="first")
    text = final_plan(matched)
    assert "skew=true" in text
    assert matched.where("song_id is not null").count() == 40_000


def test_a_hot_key_is_split_in_a_layout(spark, tiny_partitions):
    laid = layout.distribute_sort(hot_plays(spark), ["song"], ["song", "id"])
    rows = laid.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.count("*").alias("n"), F.count_if(F.col("song") == "hot").alias("hot")
    ).collect()
    assert sum(r.hot > 0 for r in rows) > 3
    assert max(r.n for r in rows) < 40_000 / 4


def test_a_hot_group_is_read_in_order_by_several_tasks(spark, tiny_partitions):
    ordered = layout.read_in_order(hot_plays(spark), ["song"], ["id"])
    parts = ordered.withColumn("p", F.spark_partition_id()).where("song = 'hot'").groupBy("p").agg(
        F.min("id").alias("a"), F.max("id").alias("b")).orderBy("p").collect()
    assert len(parts) > 1
    assert all(x.b < y.a for x, y in zip(parts, parts[1:]))


def test_merged_rows_are_shuffled_once_unless_a_key_is_hot(spark, tiny_partitions, monkeypatch):
    def newest(df):
        return merge.last_wins(df, ["song", "user"], ["id"])

    even = spark.range(0, 40_000, 1, 8).selectExpr(
        "concat('song ', id % 5000) AS song", "id % 10000 AS user", "sha2(string(id), 256) AS payload", "id")
    hot = even.withColumn("song", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("song")))
    blank = even.withColumn("song", F.when(F.col("id") % 7 > 0, F.col("song")))
    usual = layout.HOT_SHARE
    for rows, limit, shuffles in ((even, usual, 1), (hot, usual, 2), (blank, usual, 2), (hot, 2000, 1)):
        monkeypatch.setattr(layout, "HOT_SHARE", limit)
        laid = layout.distribute_merged(rows, ["song"], ["song", "user"], newest)
        assert final_plan(laid).count("Exchange ") == shuffles
        assert sorted(map(str, laid.collect())) == sorted(map(str, newest(rows).collect()))
    assert layout.distribute_merged(even.limit(0), ["song"], ["song", "user"], newest).collect() == []
    parts = layout.distribute_merged(even, ["song"], ["song", "user"], newest).withColumn("p", F.spark_partition_id())
    assert parts.groupBy("song").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
