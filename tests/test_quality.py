import pytest

from starloom.contracts import ARTISTS, SONGS, TIMES, USERS
from starloom.operators import quality
from starloom.operators.quality import Expectation, QualityError


def report(df):
    return {r.check_name: r.violations for r in df.collect()}


@pytest.fixture
def songs(spark):
    return spark.createDataFrame(
        [("S1", "T", "A1", 1999, 10.0), ("S1", "U", "A1", 0, 20.0), ("S2", None, "A9", -1, 0.0)],
        "song_id string, title string, artist_id string, year int, duration double",
    )


def test_contract_report(spark, songs):
    artists = spark.createDataFrame([("A1", "x")], "artist_id string, artist_name string")
    got = report(quality.contract_report(songs, SONGS, {"artists": artists}))
    assert got["not_null:title"] == 1 and got["not_null:song_id"] == 0
    assert got["check:year_range"] == 1 and got["check:duration_range"] == 1
    assert got["primary_key:song_id"] == 1
    assert got["foreign_key:artist_id"] == 1
    assert got["max_length:song_id"] == 0


def test_coordinates_may_be_nan_or_missing(spark):
    df = spark.createDataFrame(
        [("A", "n", None, float("nan"), 200.0), ("B", "n", None, None, None)],
        "artist_id string, artist_name string, artist_location string, artist_latitude double, "
        "artist_longitude double",
    )
    got = report(quality.check_ranges(df, ARTISTS))
    assert got == {"check:latitude_range": 0, "check:longitude_range": 1}


def test_time_ranges(spark):
    df = spark.createDataFrame([(24, 0, 54, 13, 2018, 7), (0, 1, 0, 1, 2018, 0)],
                               "hour int, day int, week int, month int, year int, weekday int")
    assert set(report(quality.check_ranges(df, TIMES)).values()) == {1}


def test_null_counts_do_count_nulls(spark):
    df = spark.createDataFrame([(None,), ("a",)], "name string")
    assert report(quality.null_counts(df)) == {"null:name": 1}
    with pytest.raises(QualityError):
        quality.assert_quality(quality.null_counts(df))
    quality.assert_quality(quality.null_counts(df), allowed={"null:name": 1})


def test_has_rows(spark):
    got = report(quality.has_rows({"full": spark.range(3), "empty": spark.range(0)}))
    assert got == {"has_rows:full": 0, "has_rows:empty": 1}


def test_required_columns(spark):
    names = USERS.column_names
    df = spark.createDataFrame([], USERS.schema)
    assert quality.required_columns(df, names) == []
    assert len(quality.required_columns(df, names[:-1])) == 1
    assert len(quality.required_columns(df, [*names[:-1], "x"])) == 1
    assert len(quality.required_columns(df, names[::-1])) == 4


def test_cardinality_covers_all_groups(spark):
    df = spark.createDataFrame([("a",)] * 12 + [("b",)] * 11 + [("c",)] * 13, "city string")
    got = sorted((r.city, r.n) for r in quality.wrong_cardinality(df, ["city"], 12).collect())
    assert got == [("b", 11), ("c", 13)]
    assert report(quality.group_cardinality(df, ["city"], 12)) == {"rows_per_group:city": 2}


def test_foreign_key_counts_rows_and_skips_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    got = quality.foreign_key(child, "k", spark.createDataFrame([(1,)], "k int"), "k")
    assert report(got) == {"foreign_key:k": 2}


def test_expect(spark):
    rows = quality.expect(spark, [
        Expectation("equal", "SELECT 3", 3),
        Expectation("different", "SELECT 3", 4),
        Expectation("nothing", "SELECT 1 WHERE false", 1),
        Expectation("within", "SELECT 3", at_most=5),
        Expectation("null", "SELECT CAST(NULL AS int)", 0),
    ])
    assert {r.check_name: r.passed for r in rows.collect()} == {
        "equal": True, "different": False, "nothing": False, "within": True, "null": False
    }
    with pytest.raises(QualityError, match="different"):
        quality.assert_quality(rows)
