import statistics

import pytest
from pyspark.sql import functions as F

from starloom import session
from starloom.operators import aggregates, keys


def test_dense_key_is_a_row_number(spark):
    df = spark.range(1000).withColumn("v", F.pmod(F.col("id") * 7919, F.lit(1000)))
    numbered = keys.dense_key(df, [F.col("v").desc()], "n", start=1, partitions=5)
    rows = sorted((r.n, r.v) for r in numbered.collect())
    assert rows == [(i + 1, 999 - i) for i in range(1000)]


def test_dense_key_of_an_empty_table(spark):
    assert keys.dense_key(spark.range(0), ["id"], "n").isEmpty()


def test_a_third_of_the_rows_may_be_copies(spark, monkeypatch):
    """Copies are unfolded in chunks, each with its own numbers."""
    monkeypatch.setattr(keys, "UNFOLD", 7)
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v")
    )
    rows = sorted((r.n, r.v) for r in keys.dense_key(df, ["v"], "n", unique=False).collect())
    assert [n for n, _ in rows] == list(range(300))
    assert [v for _, v in rows] == sorted(v for _, v in rows)
    assert sum(v == -1 for _, v in rows) == 100


def test_equal_order_values_are_split_over_partitions(spark):
    """A hot order value is spread by the columns after it."""
    df = spark.range(2000).select(F.lit(1).alias("hot"), "id")
    saved = keys._ranged(df, [F.col("hot"), F.col("id")], 4)
    sizes = [r["count"] for r in saved.groupBy(keys.PART).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1000


def test_hashed_key_repeats_and_monotonic_key_does_not(spark):
    df = spark.createDataFrame([(1, "2018-11-01 10:00:00"), (1, "2018-11-01 10:00:00")],
                               "s int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert keys.hashed_key(df, ["s", "t"]).select("id").distinct().count() == 1
    assert keys.monotonic_key(df).select("id").distinct().count() == 2


@pytest.mark.parametrize("size", [1, 2, 7, 200])
def test_median(spark, size):
    values = [float((i * 37) % 11) for i in range(size)]
    rows = [("a", v) for v in values] + [("b", 1.0), ("b", None), (None, 4.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in aggregates.median_by_group(df, ["g"], "v").collect()}
    assert got == {"a": statistics.median(values), "b": 1.0, None: 3.0}


def test_weighted_median(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 5, 1), ("a", 9, 4)], "g string, v int, n bigint")
    got = aggregates.median_by_group(df, ["g"], "v", weight="n").first().median
    assert got == statistics.median([1] * 3 + [5] + [9] * 4)


def test_rows_at_max_keeps_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w")], "g string, m int, v string"
    )
    got = sorted(r.v for r in aggregates.rows_at_max(df, ["g"], "m").collect())
    assert got == ["w", "y", "z"]


def test_row_keys_tell_nulls_and_borders_apart(spark):
    rows = [(1, "a", "b"), (1, "ab", ""), (1, None, "b"), (None, "a", "b"), (1, "a", None)]
    df = keys.row_key(spark.createDataFrame(rows, "s int, x string, y string"), ["s", "x", "y"], "k")
    assert len({r.k for r in df.collect()}) == 5 and df.where("k IS NULL").isEmpty()


def test_median_without_a_group(spark):
    df = spark.range(1, 5).select(F.col("id").cast("double").alias("v"))
    rows = aggregates.median_by_group(df, [], "v").collect()
    assert [tuple(r) for r in rows] == [(2.5,)]


def test_scratch_is_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_paths", set())

    def stored():
        return [p for p in session._scratch_paths if session.stored_bytes(spark, p)]

    with session.kept(spark.range(3), "t") as rows:
        assert rows.count() == 3 and len(stored()) == 1
    assert not session._scratch_paths
    with session.scratch_made() as made:
        assert keys.dense_key(spark.range(3), ["id"], "n").count() == 3
    assert set(stored()) == made != set()
    path = next(iter(made))
    session.clear_scratch(spark)
    assert not session._scratch_paths
    with pytest.raises(Exception, match="does not exist"):
        session.stored_bytes(spark, path)


def test_only_a_session_in_one_process_may_use_a_local_folder(monkeypatch):
    class Fake:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local-cluster[3,2,1024]"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Fake, "t")
