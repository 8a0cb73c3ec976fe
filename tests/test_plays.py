"""The star under each preset, on a small log with repeats, blanks and two levels per user."""

import pytest
from pyspark.sql import functions as F

from starloom.contracts import PLAY_LOG, SONG_CATALOG, SONGPLAYS
from starloom.plans import analytics, plays, query_tables, refresh
from starloom.operators.quality import QualityError
from starloom.operators.tables import exists, write_json, write_table


def event(ts, item=0, user="10", level="free", song="T", artist="A", length=246.9, page="NextSong",
          session=1, location="San Jose, CA"):
    return dict(
        artist=artist, auth="Logged In", firstName="Ann", gender="F", itemInSession=item,
        lastName="Lee", length=length, level=level, location=location, method="PUT", page=page,
        registration=1.5e12, sessionId=session, song=song, status=200, ts=ts, userAgent="agent",
        userId=user,
    )


T0 = 1542758400000  # 2018-11-21 00:00:00


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        event(T0 + 100), event(T0 + 900, item=1),               # one second, two plays
        event(T0 + 5000, item=2, level="paid"),                  # the level changes
        event(T0 - 5000, item=0, session=2, song="T", artist="B", length=50.0),
        event(T0 + 6000, item=3, song="none", artist="C", length=1.0),
        event(T0 + 7000, item=4, page="Home", song=None, artist=None, length=None),
        event(T0 + 8000, item=0, user="", session=3, song="T", artist="A"),
    ]
    return spark.createDataFrame([tuple(r.values()) for r in rows], PLAY_LOG.schema)


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([
        (1, "A1", None, None, "", "A", "S1", "T", 246.9, 0),
        (1, "A1", 10.0, 20.0, "Home", "A", "S2", "T", 246.1, 2004),
        (1, "B1", None, None, " ", "B", "S3", "T", 50.0, 1999),
    ], SONG_CATALOG.schema)


def star(events, catalog, preset):
    return plays.build_play_star(events, catalog, preset)


def test_upsert(events, catalog):
    tables = star(events, catalog, plays.UPSERT)
    fact = tables["songplays"].orderBy("songplay_id").collect()
    assert [r.songplay_id for r in fact] == [1, 2, 3, 4, 5, 6]
    assert [r.song_id for r in fact] == ["S3", "S1", "S1", "S1", None, "S1"]
    assert fact[1].start_time.microsecond == 100000
    users = tables["users"].collect()
    assert [(r.user_id, r.level) for r in users] == [(10, "free")]  # the newest play was free
    times = {r.start_time.microsecond: r.weekday for r in tables["times"].collect()}
    assert times[100000] == 2  # Wednesday, Monday = 0
    artists = {r.artist_id: r.artist_location for r in tables["artists"].collect()}
    assert artists == {"A1": "Home", "B1": None}


def test_warehouse(events, catalog):
    tables = star(events, catalog, plays.WAREHOUSE)
    fact = tables["songplays"].collect()
    # Both songs of (T, A) match; the two plays of one second become one.
    assert len(fact) == 2 + 2 + 1 + 2
    assert sorted(r.songplay_id for r in fact) == list(range(7))
    assert {r.level for r in tables["users"].collect()} == {"free", "paid"}
    assert {r.weekday for r in tables["times"].collect()} == {3, 2}
    assert tables["artists"].count() == 3


def test_lake(events, catalog):
    tables = star(events, catalog, plays.LAKE)
    fact = tables["songplays"].collect()
    assert len({r.songplay_id for r in fact}) == len(fact)
    assert tables["users"].where("user_id is null").isEmpty()
    assert {r.artist_location for r in tables["artists"].collect()} == {None, "Home"}
    pairs = {(r.song_id, r.artist_id) for r in fact}
    assert ("S3", "A1") in pairs  # joined by title alone


def test_scheduled(events, catalog):
    fact = star(events, catalog, plays.SCHEDULED)["songplays"].collect()
    # 246.9 and 246.1 agree in whole seconds: two rows per play of (T, A).
    assert len(fact) == 4 * 2 + 1 + 1
    assert len({r.songplay_id for r in fact}) < len(fact)
    assert sum(r.song_id is None for r in fact) == 1


@pytest.mark.parametrize("preset", [plays.UPSERT, plays.WAREHOUSE, plays.LAKE, plays.SCHEDULED])
def test_columns_are_those_of_the_contract(events, catalog, preset):
    fact = star(events, catalog, preset)["songplays"]
    assert fact.columns == SONGPLAYS.column_names


def test_reports(spark, events, catalog):
    tables = star(events, catalog, plays.UPSERT)
    fact, songs, artists = tables["songplays"], tables["songs"], tables["artists"]
    assert [(r.artist_name, r.artist_plays) for r in analytics.top_artists(fact, artists).collect()
            ] == [("A", 4), ("B", 1)]
    assert analytics.matched_plays(fact).count() == 5
    chain = analytics.song_plays_chain(fact, songs, artists).collect()
    assert [r.total_plays for r in chain] == [1, 4]
    assert analytics.plays_on_day(fact, 2018, 11, 21).first().plays == 5
    assert analytics.plays_on_day(fact, 2017, 1, 1).first().plays == 0
    assert analytics.plays_at(fact, tables["times"], year=2018, month=11, day=21).first().plays == 5
    assert analytics.top_songs_latest(fact, songs, artists, interval="3 seconds").first().plays == 2
    assert analytics.top_locations(fact).first().plays == 6


def test_query_tables(spark, events, tmp_path):
    events.drop("userAgent").write.option("header", True).csv(str(tmp_path / "in" / "nested"))
    paths = query_tables.run_query_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    table = {k: spark.read.parquet(v) for k, v in paths.items()}
    assert analytics.song_by_session_item(
        table["song_by_item_in_session"], 1, 3).first().song == "none"
    history = analytics.session_history(table["history_by_session"], 10, 1).collect()
    assert [r.item_in_session for r in history] == [0, 1, 2, 3]
    assert analytics.users_by_song(table["users_by_song"], "T").count() == 1
    assert query_tables.clean_union(events).columns == query_tables.CLEAN_COLUMNS


def test_query_tables_shuffle_plays_once_each(spark, tmp_path, monkeypatch):
    """Only their columns and rows; what is written are the merged tables."""
    rows = [event(T0 + k, k % 4, str(k % 900 or ""), song=f"S{k % 2900}", session=k // 2)
            for k in range(6000)]
    events = spark.createDataFrame([tuple(r.values()) for r in rows], PLAY_LOG.schema)
    events.drop("userAgent").write.option("header", True).csv(str(tmp_path / "in"))
    laid, plain = [], query_tables.distribute_merged

    def kept(*args):
        laid.append(plain(*args)._jdf.queryExecution())
        return plain(*args)

    monkeypatch.setattr(query_tables, "distribute_merged", kept)
    paths = query_tables.run_query_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    for execution in laid:
        text = execution.executedPlan().toString()
        assert text.count("Exchange ") == 1
        assert "Filter atleastnnonnulls" in text.split("Exchange ")[1]
    assert len(laid) == 3
    assert not any("artist" in e.executedPlan().toString() for e in laid[2:])
    want = query_tables.build_query_tables(query_tables.typed_plays(events))
    for name, path in paths.items():
        got = spark.read.parquet(path)
        assert sorted(map(str, got.collect())) == sorted(map(str, want[name].collect())), name


def test_hourly_refresh_in_two_runs_equals_one(spark, events, catalog, tmp_path):
    def run(out, drops):
        for i, rows in enumerate(drops):
            write_json(rows, f"{tmp_path}/{out}/log/{i}")
            paths = refresh.run_hourly(spark, f"{tmp_path}/{out}/log", catalog, f"{tmp_path}/{out}/o")
        return {k: sorted(map(str, v.collect())) for k, v in refresh.read_tables(spark, paths).items()}

    known = events.where("userId <> ''")
    late, early = known.where("sessionId = 1"), known.where("sessionId = 2")
    one, two = run("one", [known]), run("two", [late, early])
    assert one == two
    assert len(one["users"]) == 1 and "free" in one["users"][0]
    again = run("two", [late, early])  # the same files are not read twice
    assert again["songplays"] == two["songplays"]


def test_a_refresh_keeps_every_row_and_stops_at_bad_lines(spark, events, catalog, tmp_path):
    """Two plays of one session in one second, and a line that cannot be loaded."""
    known = events.where("userId <> '' AND page = 'NextSong'")
    twin = known.limit(1).withColumn("itemInSession", F.col("itemInSession") + 500)
    write_json(known.unionByName(twin), f"{tmp_path}/log/0")
    paths = refresh.run_hourly(spark, f"{tmp_path}/log", catalog, f"{tmp_path}/o")
    fact = spark.read.parquet(paths["songplays"])
    rows = fact.count()
    assert rows >= known.count() + 1 == known.unionByName(twin).count()
    assert fact.select("songplay_id").distinct().count() == rows
    spark.createDataFrame([("{cut",), ("",)], "value string").write.text(f"{tmp_path}/log/1")
    with pytest.raises(Exception, match="max_error"):
        refresh.run_hourly(spark, f"{tmp_path}/log", catalog, f"{tmp_path}/o")
    refresh.run_hourly(spark, f"{tmp_path}/log", catalog, f"{tmp_path}/o", max_error=1)
    assert spark.read.parquet(paths["songplays"]).count() == rows


def test_checks_come_before_the_tables_are_public(spark, events, catalog, tmp_path):
    write_json(events, f"{tmp_path}/log")
    bad = catalog.withColumn("artist_name", F.lit("x" * 300))
    write_json(bad.drop("_order"), f"{tmp_path}/songs")
    with pytest.raises(QualityError, match="max_length:artist_name"):
        plays.run_play_star(spark, f"{tmp_path}/log", f"{tmp_path}/songs", f"{tmp_path}/out")
    assert not exists(spark, f"{tmp_path}/out/songplays") and not exists(spark, f"{tmp_path}/out/artists")


def test_day_and_week_open_only_their_folders(spark, events, tmp_path):
    from starloom.operators.cleaning import latest_window

    times = [f"2018-{m:02d}-{d:02d} 10:00:00" for m in (10, 11, 12) for d in (1, 30)]
    fact = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("start_time"))
    write_table(plays.partitioned_by_month(fact), str(tmp_path / "f"), ["year", "month"])
    stored = spark.read.parquet(str(tmp_path / "f"))
    day = analytics.plays_on_day(stored, 2018, 11, 30)
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "year" in filters and "month" in filters and day.first().plays == 1
    week = latest_window(stored, "start_time", "31 days")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = week._jdf.queryExecution().explainString(mode)
    filters = plan.split("PartitionFilters: ")[1].split("\n")[0]
    assert "year#" in filters and "month#" in filters
    assert week.count() == 3
