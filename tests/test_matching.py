import pytest

from starloom.operators.matching import match_plays, match_plays_two_step

PLAYS = "song string, artist string, length double"
CATALOG = "song_id string, title string, artist_id string, artist_name string, duration double"


@pytest.fixture
def plays(spark):
    return spark.createDataFrame(
        [("T", "A", 246.900001), ("T", "A", 100.0), ("T", "B", 50.0), ("U", "A", 1.0),
         (None, None, None)], PLAYS,
    )


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [("S2", "T", "A1", "A", 246.9), ("S1", "T", "A1", "A", 246.1), ("S3", "T", "B1", "B", 50.0)],
        CATALOG,
    )


def found(df):
    return sorted(((r.song, r.length, r.song_id) for r in df.collect()), key=str)


def test_duration_at_five_decimals(plays, catalog):
    assert found(match_plays(plays, catalog, how="inner")) == [
        ("T", 246.900001, "S2"), ("T", 50.0, "S3")
    ]


def test_whole_seconds_cut_off_match_more(plays, catalog):
    got = found(match_plays(plays, catalog, duration_scale=0, duration_mode="truncate",
                            how="inner"))
    assert [g[2] for g in got] == ["S1", "S2", "S3"]


def test_without_duration_all_or_first(plays, catalog):
    every = match_plays(plays, catalog, duration_scale=None, how="inner")
    assert every.count() == 5
    first = match_plays(plays, catalog, duration_scale=None, pick="first")
    assert first.count() == plays.count()
    assert ("T", 100.0, "S1") in found(first)


def test_unmatched_plays_stay_with_null_ids(plays, catalog):
    rows = match_plays(plays, catalog).collect()
    assert len(rows) == 5
    assert sum(r.song_id is None and r.artist_id is None for r in rows) == 3


def test_two_step_may_mix_artists_and_strict_may_not(spark, plays, catalog):
    songs = catalog.select("song_id", "title", "artist_id")
    artists = catalog.select("artist_id", "artist_name").distinct()
    loose = match_plays_two_step(plays, songs, artists)
    assert loose.count() == 9
    strict = match_plays_two_step(plays, songs, artists, strict=True)
    assert strict.count() == 5


def test_bad_options_are_refused(plays, catalog):
    with pytest.raises(ValueError):
        match_plays(plays, catalog, pick="any")
    with pytest.raises(ValueError):
        match_plays(plays, catalog, duration_mode="floor")
