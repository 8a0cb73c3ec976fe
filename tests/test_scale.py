"""What grows with the input: rows that are moved, months that are named, text that is stored."""

import os

from pyspark.sql import functions as F

from starloom import session
from starloom.contracts import PLAY_LOG, SONG_CATALOG
from starloom.operators import tables
from starloom.plans import plays
from starloom.plans.matches import in_months
from starloom.sources.files import scan_json
from starloom.sources.staging import read_lines

SCHEMA = "k int, v string"


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_only_keys_that_come_again_are_grouped(spark, tmp_path, monkeypatch):
    path, seen, whole = str(tmp_path / "t"), [], tables._one_per_key

    def watched(rows, key):
        seen.append(rows.count())
        return whole(rows, key)

    monkeypatch.setattr(tables, "_one_per_key", watched)
    tables.append_fact(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, ["k"])
    batch = [(2, "b"), (3, "c"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]
    tables.append_fact(spark.createDataFrame(batch, SCHEMA), path, ["k"])
    assert seen == [0, 3]
    assert stored(spark, path) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]


def test_equal_hashes_of_different_keys_lose_nothing(spark, tmp_path, monkeypatch):
    def all_of(batch, existing, unknown, key):
        return batch.where(~unknown).select(F.xxhash64(*key).alias(tables.HASH)).distinct()

    monkeypatch.setattr(tables, "_repeated", all_of)
    path, torn = str(tmp_path / "t"), str(tmp_path / "torn")
    tables.append_fact(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, ["k"])
    batch = [(2, "b"), (3, "c"), (4, "d"), (4, "e"), (None, "n")]
    tables.append_fact(spark.createDataFrame(batch, SCHEMA), path, ["k"], conflicts=torn)
    assert {r.k for r in spark.read.schema(SCHEMA).parquet(path).collect()} == {1, 2, 3, None}
    assert stored(spark, torn) == [(4, "d"), (4, "e")]


def test_many_months_are_one_condition(spark):
    months = [(2000 + i // 12, 1 + i % 12) for i in range(84)]
    rows = spark.createDataFrame([(1999, 12), (2000, 1), (2006, 12), (2007, 1)], "year int, month int")
    assert sorted(map(tuple, rows.where(in_months(months)).collect())) == [(2000, 1), (2006, 12)]
    assert rows.where(in_months([])).isEmpty() and rows.where(~in_months([])).count() == 4
    plan = rows.where(in_months(months))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("year#") < 10


def test_compressed_logs_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.write_json(spark.range(50).select(F.col("id").alias("sessionId"), F.lit("NextSong").alias("page")), path, True)
    assert any(name.endswith(".json.gz") for name in os.listdir(path))
    assert scan_json(spark, path, PLAY_LOG).where("page = 'NextSong'").select(F.sum("sessionId")).first()[0] == 1225
    assert read_lines(spark, path).count() == 50


def test_shuffles_begin_with_partitions_for_the_size(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    before = {k: spark.conf.get(k, None) for k in (*session.TABLE_CONF, session.INITIAL_PARTITIONS)}
    spark.range(100_000).select(F.uuid().alias("u")).write.parquet(path)
    try:
        session.configure_tables(spark, path, str(tmp_path / "absent"))
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 50_000)
        session.configure_tables(spark, path)
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == session.stored_bytes(spark, path) // 50_000 > 8
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_several_stars_parse_their_input_once(spark, tmp_path):
    log, songs = str(tmp_path / "log"), str(tmp_path / "songs")
    play = dict(artist="a", auth="x", firstName="f", gender="F", itemInSession=1, lastName="l", length=1.0,
                level="free", location="p", method="PUT", page="NextSong", registration=1.0, sessionId=7,
                song="s", status=200, ts=1_541_106_106_796, userAgent="u", userId="3")
    song = dict(num_songs=1, artist_id="A", artist_latitude=1.0, artist_longitude=1.0, artist_location="p",
                artist_name="a", song_id="S", title="s", duration=1.0, year=2000)
    tables.write_json(spark.createDataFrame([play], PLAY_LOG.schema), log)
    tables.write_json(spark.createDataFrame([song], SONG_CATALOG.schema), songs)
    with plays.stored_inputs(spark, log, songs) as inputs:
        tables.drop_table(spark, log), tables.drop_table(spark, songs)
        for name in ("default", "warehouse", "scheduled"):
            paths = plays.run_play_star(
                spark, log, songs, f"{tmp_path}/{name}", plays.PRESETS[name], inputs=inputs)
            fact = spark.read.parquet(paths["songplays"])
            assert fact.columns == [*plays.SONGPLAYS.column_names, "year", "month"]
            assert [(r.song_id, r.user_id, r.month) for r in fact.collect()] == [("S", 3, 11)]


def test_digests_are_added_after_the_rows_are_moved(spark, tmp_path, monkeypatch):
    moved, move = [], tables.repartition_by_columns
    monkeypatch.setattr(tables, "repartition_by_columns", lambda df, c: moved.append(df.columns) or move(df, c))
    rows = spark.createDataFrame([(1, 2000), (2, 2001)], "k int, year int")
    fresh = tables.stage_in(rows, str(tmp_path / "t"), ["year"], late=lambda r: r.withColumn("d", F.md5(F.col("k").cast("string"))))
    assert moved == [["k", "year"]] and fresh.where("d = md5(cast(k as string))").count() == 2
    tables.write_table(rows, str(tmp_path / "u"), ["year"], gather=False)
    assert len(moved) == 1
