"""Plays whose songs come later, and plays that contradict each other."""

import os

import pytest
from pyspark.sql import functions as F

from starloom.operators.tables import write_json
from starloom.plans import plays, refresh
from starloom.plans.matches import changed_keys
from tests.test_plays import T0, event

SONG = ("num_songs int, artist_id string, artist_latitude double, artist_longitude double, artist_location string, "
        "artist_name string, song_id string, title string, duration double, year int, _order int")
MONTH = 31 * 24 * 3600 * 1000


def song(n, title, artist="A", duration=246.9):
    return (1, f"AR{artist}", None, None, "", artist, f"S{n}", title, duration, 0, n)


def stored(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet")}


@pytest.fixture
def world(spark, tmp_path):
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"

    def drop(name, rows):
        write_json(spark.createDataFrame(rows), f"{log}/{name}")

    def run(songs, preset=refresh.HOURLY):
        catalog = spark.createDataFrame(songs, SONG)
        paths = refresh.run_hourly(spark, log, catalog, out, preset)
        return refresh.read_tables(spark, paths)

    return drop, run, out


def facts(tables):
    rows = [(r.start_time.month, r.session_id, r.song_id or "") for r in tables["songplays"].collect()]
    return sorted(rows, key=lambda r: r[1:])


@pytest.mark.parametrize("preset", [refresh.HOURLY, plays.DEFAULT])
def test_songs_that_come_later_are_matched_and_other_months_are_left(spark, world, preset):
    drop, run, out = world
    drop("0", [event(T0, session=1, song="T"), event(T0 + MONTH, session=2, song="U"),
               event(T0 + 2 * MONTH, session=3, song="V")])
    first = run([song(1, "T")], preset)
    months = [m for m, _, _ in facts(first)]
    assert [s for _, _, s in facts(first)] == ["S1", "", ""]
    before = stored(f"{out}/songplays")
    tables = run([song(1, "T"), song(2, "U")], preset)
    assert [s for _, _, s in facts(tables)] == ["S1", "S2", ""]
    after = stored(f"{out}/songplays")
    kept = [f for f in after if before.get(f) == after[f]]
    assert {m for m in months if any(f"/month={m}/" in f for f in kept)} == set(months) - {months[1]}
    assert not any(f"/month={months[1]}/" in f for f in kept)
    # nothing new: nothing is written
    run([song(1, "T"), song(2, "U")], preset)
    assert stored(f"{out}/songplays") == after


def test_the_fact_follows_the_catalog_both_ways(spark, world):
    """A second match, a song that goes, and a new drop in a month that is built again."""
    drop, run, out = world
    drop("0", [event(T0, session=1, song="T"), event(T0, session=2, song="U")])
    run([song(1, "T"), song(2, "U")])
    drop("1", [event(T0 + 60_000, session=3, song="T"), event(T0 + 60_000, session=4, song="none")])
    tables = run([song(1, "T"), song(3, "T")])
    assert [(n, s) for _, n, s in facts(tables)] == [(1, "S1"), (1, "S3"), (2, ""), (3, "S1"), (3, "S3"), (4, "")]
    assert tables["songplays"].select("songplay_id").distinct().count() == 6


def test_a_run_that_stops_is_made_good(spark, world, monkeypatch):
    from starloom.plans import matches

    drop, run, out = world
    drop("0", [event(T0, session=1, song="T"), event(T0 + MONTH, session=2, song="U")])
    run([song(1, "T")])
    drop("1", [event(T0 + 2 * MONTH, session=3, song="U"), event(T0 + 3 * MONTH, session=4, song="none")])

    def stop(*_, **__):
        raise RuntimeError("stopped")

    for name in ("write_table", "append_fact", "replace_snapshot"):
        with monkeypatch.context() as patch:
            patch.setattr(matches, name, stop)
            with pytest.raises(Exception, match="stopped"):
                run([song(1, "T"), song(2, "U")])
    tables = run([song(1, "T"), song(2, "U")])
    assert [(n, s) for _, n, s in facts(tables)] == [(1, "S1"), (2, "S2"), (3, "S2"), (4, "")]


def test_plays_that_contradict_each_other_go_aside(spark, world):
    drop, run, out = world
    clash = [event(T0, session=1, song="T"), {**event(T0, session=1, song="T"), "location": "elsewhere"}]
    drop("0", [*clash, event(T0, session=2, song="T")])
    tables = run([song(1, "T")])
    assert [n for _, n, _ in facts(tables)] == [2]
    aside = spark.read.parquet(f"{out}/conflicts")
    assert aside.count() == 2 and {r.sessionId for r in aside.collect()} == {1}
    drop("1", [event(T0, session=5, song="T")])
    assert [n for _, n, _ in facts(run([song(1, "T")]))] == [2, 5]


def test_a_fact_with_unknown_keys_is_refused(spark, world, tmp_path):
    """The keys are kept apart from the dimension, and miss an artist that the catalog has."""
    from starloom.operators.quality import QualityError
    from starloom.operators.snapshots import replace_snapshot

    drop, run, out = world
    catalog = spark.createDataFrame([song(1, "T"), song(2, "U", artist="B")], SONG)
    dims = plays.build_song_dims(catalog, refresh.HOURLY)
    keys = {"song_id": f"{tmp_path}/song_keys", "artist_id": f"{tmp_path}/artist_keys"}
    replace_snapshot(dims["songs"].select("song_id"), keys["song_id"], ["song_id"], 4)
    replace_snapshot(dims["artists"].select("artist_id").where("artist_id = 'ARA'"), keys["artist_id"], ["artist_id"], 4)

    def go():
        refresh.run_hourly(spark, f"{tmp_path}/log", catalog, out, dims=dims, keys=keys)
        return spark.read.parquet(f"{out}/songplays").count()

    drop("0", [event(T0, session=1, song="T")])
    assert go() == 1
    drop("1", [event(T0 + MONTH, session=2, song="U", artist="B")])
    with pytest.raises(QualityError, match="foreign_key:artist_id"):
        go()
    assert spark.read.parquet(f"{out}/songplays").count() == 1
    replace_snapshot(dims["artists"].select("artist_id"), keys["artist_id"], ["artist_id"], 4)
    assert go() == 2


def test_changed_keys(spark):
    schema = "match_key bigint, song_id string, artist_id string"
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, "d", "x")], schema)
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (2, "e", "x"), (3, "c", None), (5, "f", "x")], schema)
    assert sorted(r[0] for r in changed_keys(old, new).collect()) == [2, 4, 5]
    assert changed_keys(old, old.select(*[F.col(c) for c in reversed(old.columns)])).count() == 0
