"""Batches that are written once, beside their table, and moved in."""

import os

import pytest

from starloom.contracts import STAGED_EVENTS
from starloom.operators import tables
from starloom.operators.tables import append_fact, beside, missing_in, move_in, write_json
from starloom.plans import refresh
from starloom.plans.matches import BATCH, plays_kept
from starloom.sources.staging import stage_lines
from starloom.streaming import incremental
from tests.test_matches import MONTH, SONG, song, stored
from tests.test_plays import T0, event

SCHEMA = "k int, v string, m int"


def rows(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


def append(spark, batch, path, **options):
    with beside(spark.createDataFrame(batch, SCHEMA), path, ["m"]) as (found, folder):
        append_fact(found, path, ["k", "m"], ["m"], stored=True, ready=folder, **options)


def test_new_keys_are_moved_and_not_written_again(spark, tmp_path, monkeypatch):
    path, wrote, write = f"{tmp_path}/t", [], tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda *a, **o: wrote.append(a[1]) or write(*a, **o))
    append(spark, [(1, "a", 1), (2, "b", 2)], path)
    old = stored(path)
    append(spark, [(3, "c", 2), (4, "d", 3)], path)
    assert wrote == [f"{path}__batch"] * 2
    assert rows(spark, path) == [(1, "a", 1), (2, "b", 2), (3, "c", 2), (4, "d", 3)]
    assert old.items() <= stored(path).items() and not os.path.exists(f"{path}__batch")


@pytest.mark.parametrize("batch", [
    [(2, "b", 2), (3, "c", 2)], [(3, "c", 2), (3, "c", 2)], [(3, "c", 2), (None, "n", 2)], [(3, "c", 2), (5, "e", None)]])
def test_keys_that_come_again_are_compared(spark, tmp_path, batch):
    path = f"{tmp_path}/t"
    append(spark, [(1, "a", 1), (2, "b", 2)], path)
    for _ in range(2):
        append(spark, batch, path)
    new = {r for r in batch if r[0] != 2}
    assert {*rows(spark, path)} == {(1, "a", 1), (2, "b", 2), *new} and len(rows(spark, path)) == 2 + len(new)


def test_a_refused_batch_is_not_moved(spark, tmp_path):
    def refuse(_):
        raise ValueError("refused")

    path = f"{tmp_path}/t"
    append(spark, [(1, "a", 1)], path)
    with pytest.raises(ValueError, match="refused"):
        append(spark, [(2, "b", 1)], path, before=refuse)
    append(spark, [], path)
    assert rows(spark, path) == [(1, "a", 1)] and not os.path.exists(f"{path}__batch")


def test_moved_folders_replace_their_likes_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    append(spark, [(1, "a", 1), (2, "b", 2)], path)
    old = stored(path)
    with beside(spark.createDataFrame([(9, "z", 2), (8, "y", 3)], SCHEMA), path, ["m"]) as (_, folder):
        move_in(spark, folder, path, replace=True)
    assert rows(spark, path) == [(1, "a", 1), (8, "y", 3), (9, "z", 2)]
    assert {f for f in stored(path) if f in old} == {f for f in old if "/m=1/" in f}


def test_missing_keys_are_shuffled_once(spark, tmp_path):
    path, key = f"{tmp_path}/t", ["k", "m"]
    schema = "k int, m int"
    first = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], schema)
    found = missing_in(first, path, key, ["m"], first)
    tables.write_table(found, path, ["m"], gather=False)
    batch = spark.createDataFrame([(1, 1), (1, 2), (3, 2), (3, 2)], schema)
    found = missing_in(batch, path, key, ["m"], batch)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (3, 2)]
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange") == 1


def test_a_refresh_parses_and_writes_its_plays_once(spark, tmp_path, monkeypatch):
    wrote, write = [], tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda *a, **o: wrote.append(os.path.basename(a[1])) or write(*a, **o))
    monkeypatch.setattr(incremental, "kept", None)  # nothing else is stored of a batch
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    catalog = spark.createDataFrame([song(1, "T")], SONG)
    for n in (1, 2):
        plays = [event(T0 + i * MONTH, session=10 * n + i, song="T") for i in range(2)]
        write_json(spark.createDataFrame(plays), f"{log}/{n}")
        paths = refresh.run_hourly(spark, log, catalog, out)
        assert [w for w in wrote if w.startswith(("plays", "songplays"))] == ["plays__batch", "songplays__batch"] * n
    found = refresh.read_tables(spark, paths)
    assert {r.session_id: r.song_id for r in found["songplays"].collect()} == dict.fromkeys((10, 11, 20, 21), "S1")
    kept = plays_kept(spark, f"{out}/plays", [(r.year, r.month) for r in found["times"].collect()], [1])
    assert {(r.sessionId, r[BATCH]) for r in kept.collect()} == {(20, 1), (21, 1)}


def test_a_journal_without_batches_is_read(spark, tmp_path):
    path = f"{tmp_path}/plays"
    spark.createDataFrame([(1, 2018, 11)], "sessionId bigint, year int, month int").write.partitionBy("year", "month").parquet(path)
    assert plays_kept(spark, path, [(2018, 11)]).count() == 1
    assert plays_kept(spark, path, [(2018, 11)], [0]).count() == 0


def test_numbers_with_a_point_are_not_cast_in_vain(spark):
    texts = ["1.5E12", "338.0", "338", "-0.9", "1.", ".5", "x.y", "", "15E1", " 7 ", "9223372036854775807", "1e400"]
    line = '{"itemInSession":"%s","ts":"%s"}'
    lines = spark.createDataFrame([(line % (t, t),) for t in texts], "value string")
    staged = stage_lines(lines, STAGED_EVENTS, mapping="exact")
    assert [r.ts for r in staged.collect()] == [1500000000000, 338, 338, 0, 1, 0, None, None, 150, 7, 2**63 - 1, None]
    assert [r.itemInSession for r in staged.collect()] == [None, 338, 338, 0, 1, 0, None, None, 150, 7, None, None]
    assert "contains(" in staged._jdf.queryExecution().optimizedPlan().toString().lower()


def test_lines_are_not_trimmed_from_their_end(spark):
    lines = spark.createDataFrame([(" \t\r",), ("",), (' {"ts":"1"} ',), ("\t x",), (None,)], "value string")
    staged = stage_lines(lines, STAGED_EVENTS, mapping="exact")
    assert [r.ts for r in staged.collect()] == [1, None]
    text = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "(ltrim(value" in text and "(trim(value" not in text


def test_what_a_killed_run_left_is_not_taken(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(7, "old", 7)], SCHEMA).write.partitionBy("m").parquet(f"{path}__batch")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        append(spark, [(1, "a", 1)], path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark, path) == [(1, "a", 1)]


def test_folders_of_columns_with_an_underscore_are_moved(spark, tmp_path):
    path = f"{tmp_path}/t"
    with beside(spark.createDataFrame([(1, 2)], "k int, _p int"), path, ["_p"]) as (_, folder):
        move_in(spark, folder, path)
    assert [tuple(r) for r in spark.read.option("basePath", path).parquet(f"{path}/_p=2").collect()] == [(1, 2)]
