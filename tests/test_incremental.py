from pyspark.sql import functions as F

from starloom.contracts import TableContract
from starloom.operators.tables import merge_table
from starloom.streaming.incremental import run_incremental

EVENTS = TableContract("e", "id int, user int, v string, o int")


def drop(spark, path, rows):
    spark.createDataFrame(rows, EVENTS.schema).coalesce(1).write.mode("append").json(path)


def test_runs_see_each_file_once_and_each_event_once(spark, tmp_path):
    source, fact = str(tmp_path / "in"), str(tmp_path / "fact")
    users, checkpoint = str(tmp_path / "users"), str(tmp_path / "cp")

    def run():
        run_incremental(
            spark, source, EVENTS, fact, checkpoint, key=["id"],
            refresh=lambda b: merge_table(
                b.drop("id"), users, ["user"], ["o"], keep_order=True
            ),
            files_per_batch=1,
        )
        return sorted(r.id for r in spark.read.parquet(fact).collect())

    drop(spark, source, [(1, 7, "a", 1), (2, 7, "z", 9)])
    assert run() == [1, 2]
    drop(spark, source, [(2, 7, "z", 9), (3, 8, "c", 3)])  # event 2 arrives again
    drop(spark, source, [(4, 7, "old", 4)])                # late
    assert run() == [1, 2, 3, 4]
    assert run() == [1, 2, 3, 4]                           # nothing new
    got = sorted((r.user, r.v) for r in spark.read.parquet(users).collect())
    assert got == [(7, "z"), (8, "c")]
    batch = spark.read.schema(EVENTS.schema).json(source).groupBy("id").agg(F.min("o").alias("o"))
    assert batch.count() == 4
