import pytest
from pyspark.sql import functions as F

from starloom.contracts import TableContract
from starloom.operators import layout, tables

CONTRACT = TableContract("t", "id int, name string")


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def test_ensure_table_is_idempotent_and_may_drop(spark, path):
    assert tables.ensure_table(spark, CONTRACT, path).isEmpty()
    tables.insert_select(spark.createDataFrame([("a", 1)], "name string, id long"), CONTRACT, path)
    assert tables.ensure_table(spark, CONTRACT, path).count() == 1
    assert tables.ensure_table(spark, CONTRACT, path, drop_first=True).isEmpty()


SCHEMA = "k int, day string, v string"


def test_append_fact_twice_is_append_once(spark, path):
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    tables.append_fact(batch, path, ["k"])
    tables.append_fact(batch, path, ["k"])
    assert rows(spark, path) == [(1, "a"), (2, "b")]
    tables.append_fact(batch.where("k = 2"), path, ["k"], drop_first=True)
    assert rows(spark, path) == [(2, "b")]


def test_different_rows_of_a_key_fail_and_append_nothing(spark, path):
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.append_fact(good, path, ["k"])
    with pytest.raises(tables.KeyConflict, match="different rows"):
        tables.append_fact(
            spark.createDataFrame([(2, "b"), (2, "c"), (3, "d")], "k int, v string"), path, ["k"])
    with pytest.raises(RuntimeError, match="checked"):
        def refuse(batch):
            raise RuntimeError("checked")
        tables.append_fact(spark.createDataFrame([(4, "e")], "k int, v string"), path, ["k"], before=refuse)
    assert rows(spark, path) == [(1, "a")]


@pytest.mark.parametrize("folders", [[], ["day"]])
def test_rows_without_a_key_are_neither_lost_nor_repeated(spark, path, folders):
    first = [(1, "a", "x"), (None, "a", "y"), (None, "a", "y"), (None, "a", "z"), (2, None, "w")]
    second = [(None, "a", "y"), (None, "b", "y"), (3, "b", "v"), (2, None, "w")]
    for batch in (first, first, second, second):
        tables.append_fact(spark.createDataFrame(batch, SCHEMA), path, ["k", "day"], folders)
    got = [tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("k", "day", "v").collect()]
    assert sorted(got, key=str) == sorted([*first, (None, "b", "y"), (3, "b", "v")], key=str)


def test_append_reads_only_touched_partitions(spark, path):
    schema = "k int, y int, m int"
    old = [(k, 2000 + k // 12, 1 + k % 12) for k in range(36)]
    tables.append_fact(spark.createDataFrame(old, schema), path, ["k", "y", "m"], ["y", "m"])
    batch = spark.createDataFrame([(11, 2000, 12), (90, 2001, 1)], schema)
    existing = spark.read.schema(schema).parquet(path)
    touched = tables._touched(existing, batch, ["y", "m"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "2000" in plan.split("PartitionFilters")[1] and "DataFilters: []" in plan
    assert sorted((r.y, r.m) for r in touched.collect()) == [(2000, 12), (2001, 1)]
    tables.append_fact(batch, path, ["k", "y", "m"], ["y", "m"])
    assert spark.read.schema(schema).parquet(path).count() == 37


def test_an_empty_batch_reads_nothing(spark, path):
    assert tables._touched(spark.range(3), spark.range(0), ["id"]) is None
    tables.append_fact(spark.createDataFrame([(1, "a", "x")], SCHEMA), path, ["k"], ["day"])
    tables.drop_table(spark, path + "/day=a")
    (spark.range(1).withColumn("broken", F.lit(1)).write.mode("append").parquet(path + "/day=a"))
    tables.append_fact(spark.createDataFrame([], SCHEMA), path, ["k"], ["day"])


def test_load_dimension_replaces_or_adds(spark, path):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    tables.load_dimension(df, path)
    tables.load_dimension(df, path)
    assert len(rows(spark, path)) == 1
    tables.load_dimension(df, path, truncate=False)
    assert len(rows(spark, path)) == 2
    tables.load_dimension(df, path, truncate=False, drop_first=True)
    assert len(rows(spark, path)) == 1


@pytest.mark.parametrize("policy", ["last_wins", "insert_ignore", "fill_zero"])
def test_merge_table_twice_is_merge_once(spark, path, policy):
    batch = spark.createDataFrame([(1, 1, 0), (1, 2, 1999), (2, 1, 5)], "k int, o int, year int")
    tables.merge_table(batch, path, ["k"], ["o"], policy)
    once = rows(spark, path)
    tables.merge_table(batch, path, ["k"], ["o"], policy)
    assert rows(spark, path) == once
    assert len(once) == 2


def test_a_failed_merge_leaves_the_table(spark, path):
    tables.merge_table(spark.createDataFrame([(1, 1, "a")], "k int, o int, v string"), path,
                       ["k"], ["o"])
    broken = spark.createDataFrame([(1, 2, "x")], "k int, o int, v string").withColumn(
        "v", F.raise_error(F.lit("lost")).cast("string")
    )
    with pytest.raises(Exception, match="lost"):
        tables.merge_table(broken, path, ["k"], ["o"])
    assert rows(spark, path) == [(1, "a")]


def test_a_swap_that_stopped_half_way_is_repaired(spark, path):
    df = spark.createDataFrame([(1, 1, "a")], "k int, o int, v string")
    tables.merge_table(df, path, ["k"], ["o"])
    fs, p = tables.filesystem(spark, path)
    _, old = tables.filesystem(spark, path + "__old")
    fs.rename(p, old)
    tables.merge_table(spark.createDataFrame([(2, 1, "b")], df.schema), path, ["k"], ["o"])
    assert rows(spark, path) == [(1, "a"), (2, "b")]


def test_dynamic_overwrite_replaces_only_present_partitions(spark, path):
    df = spark.createDataFrame([(1, 2018), (2, 2019)], "v int, year int")
    tables.write_table(df, path, ["year"])
    again = spark.createDataFrame([(9, 2019)], "v int, year int")
    tables.write_table(again, path, ["year"], only_touched=True)
    assert rows(spark, path) == [(1, 2018), (9, 2019)]


def test_quoted_csv_quotes_every_field(spark, path):
    df = spark.createDataFrame([(1, 'a "b", c', None)], "n int, s string, e string")
    tables.write_csv_quoted(df.coalesce(1), path)
    text = "".join(r.value + "\n" for r in spark.read.text(path).collect())
    assert text.splitlines()[0] == '"n","s","e"'
    assert text.splitlines()[1].startswith('"1","a ""b"", c",')


def test_load_targets_releases_the_input(spark, path):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    tables.load_targets(df, {
        path + "/a": (lambda d: d.groupBy("g").count(), ()),
        path + "/b": (lambda d: d.select("id"), ()),
    })
    assert spark.read.parquet(path + "/a").count() == 2
    assert spark.read.parquet(path + "/b").count() == 10
    assert not df.is_cached


def test_buckets_stay_for_a_hot_key(spark, path):
    even = spark.range(1000).withColumnRenamed("id", "k")
    hot = even.withColumn("k", F.when(F.col("k") < 700, F.lit(1)).otherwise(F.col("k")))
    assert layout.largest_bucket_share(even, ["k"], 8) < 2 < layout.largest_bucket_share(hot, ["k"], 8)
    layout.bucket_table(hot, "t_hot", path + "/h", ["k"], ["k"], 8)
    assert spark.table("t_hot").count() == 1000
    assert "8" in {r.data_type for r in spark.sql("DESCRIBE EXTENDED t_hot").collect() if r.col_name == "Num Buckets"}


def test_replicate_checks_the_size(spark):
    small = layout.replicate(spark.range(10))
    large = layout.replicate(spark.range(10_000), limit=1_000)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().analyzed().toString().lower()
