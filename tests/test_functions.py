import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions import codes, numbers, text, timeparts


def one(spark, column, **values):
    """Value of a column expression over one row of values."""
    schema = ", ".join(
        f"{k} {'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}"
        for k, v in values.items()
    )
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema or "x bigint").select(column.alias("v")).first().v


def test_epoch_keeps_or_cuts_milliseconds(spark):
    ms = 1541121934796
    assert one(spark, timeparts.epoch_ms_to_timestamp(F.col("m")), m=ms) == dt.datetime(
        2018, 11, 2, 1, 25, 34, 796000
    )
    assert one(spark, timeparts.epoch_ms_to_seconds(F.col("m")), m=ms) == dt.datetime(
        2018, 11, 2, 1, 25, 34
    )
    assert one(spark, timeparts.epoch_ms_to_text(F.col("m")), m=ms) == "2018-11-02 01:25:34"
    assert one(spark, timeparts.epoch_ms_to_seconds(F.col("m")), m=-1) == dt.datetime(
        1969, 12, 31, 23, 59, 59
    )


def test_epochs_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, timeparts.epoch_ms_to_text(F.col("m")), m=0) == "1970-01-01 00:00:00"
        back = timeparts.timestamp_to_epoch_ms(timeparts.epoch_ms_to_timestamp(F.col("m")))
        assert one(spark, back, m=1541121934796) == 1541121934796
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "day, mon0, sun0", [("2018-11-18", 6, 0), ("2018-11-19", 0, 1), ("2018-11-24", 5, 6)]
)
def test_weekdays(spark, day, mon0, sun0):
    ts = timeparts.parse_timestamp(F.col("d"))
    assert one(spark, timeparts.weekday_mon0(ts), d=day) == mon0
    assert one(spark, timeparts.weekday_sun0(ts), d=day) == sun0
    assert one(spark, timeparts.weekday_sun0(ts, as_text=True), d=day) == str(sun0)


def test_sas_days(spark):
    assert one(spark, timeparts.sas_date_text(F.col("d")), d=20545.0) == "2016-04-01"
    assert one(spark, timeparts.sas_date_text(F.col("d")), d=0.0) == "1960-01-01"


def test_year_bounds_are_inclusive(spark):
    days = spark.createDataFrame(
        [("1999-12-31",), ("2000-01-01",), ("2001-12-31",), ("2002-01-01",)], "d string"
    ).select(F.col("d").cast("date"))
    kept = days.where(timeparts.within_years(F.col("d"), 2000, 2001))
    assert [str(r.d) for r in kept.orderBy("d").collect()] == ["2000-01-01", "2001-12-31"]
    assert days.where(timeparts.within_years(F.col("d"))).count() == 4
    assert days.where(timeparts.within_years(F.col("d"), max_year=1999)).count() == 1


@pytest.mark.parametrize(
    "value, scale, mode, want",
    [
        (246.9, 0, "truncate", 246), (246.9, 0, "round", 247), (246.5, 0, "round", 247),
        (-246.9, 0, "truncate", -246), (0.29, 2, "truncate", 0.29), (1.239, 2, "truncate", 1.23),
        (495.307301, 5, "round", 495.3073),
    ],
)
def test_fit_decimal(spark, value, scale, mode, want):
    assert float(one(spark, numbers.fit_decimal(F.col("v"), scale, mode), v=value)) == want


def test_casts_give_null_for_text_that_does_not_fit(spark):
    assert one(spark, numbers.to_int(F.col("v")), v="") is None
    assert one(spark, numbers.to_int(F.col("v")), v="12") == 12
    assert one(spark, numbers.to_double(F.col("v")), v="x") is None
    assert one(spark, numbers.nan_to_null(F.col("v")), v=float("nan")) is None


@pytest.mark.parametrize("value, want", [("", None), (" \t\n ", None), (" a ", " a ")])
def test_blank_to_null(spark, value, want):
    assert one(spark, text.blank_to_null(F.col("v")), v=value) == want


@pytest.mark.parametrize(
    "value, length, unit, want",
    [
        ("héllo", 2, "chars", "hé"), ("héllo", 2, "bytes", "h"), ("héllo", 3, "bytes", "hé"),
        ("ab", 5, "bytes", "ab"), ("日本", 5, "bytes", "日"), ("", 3, "bytes", ""),
    ],
)
def test_truncate(spark, value, length, unit, want):
    assert one(spark, text.truncate(F.col("v"), length, unit), v=value) == want


@pytest.mark.parametrize(
    "label, city, state",
    [
        ("ALCAN, AK             ", "alcan", "ak"),
        ("MARIPOSA AZ", "mariposa", "az"),
        ("PASO DEL NORTE,TX     ", "paso del norte", "tx"),
        ("DEW STATION PT LAY DEW, AK", "dew station pt lay dew", "ak"),
        ("MARFA, TX (BPS)", "marfa", "tx"),
        ("NOT REPORTED/UNKNOWN  ", "not reported/unknown", None),
        ("A, B, CA", "a, b", "ca"),
    ],
)
def test_city_and_state(spark, label, city, state):
    found = text.split_city_state(F.col("v"))
    assert one(spark, found[0], v=label) == city
    assert one(spark, found[1], v=label) == state


def test_city_and_state_legacy(spark):
    city, state = text.split_city_state(F.col("v"), legacy=True)
    assert (one(spark, city, v="ST CLAIR, MI "), one(spark, state, v="ST CLAIR, MI ")) == (
        "st clair", "mi"
    )
    assert (one(spark, city, v="BAKER AAF AK"), one(spark, state, v="BAKER AAF AK")) == (
        "baker,aaf", "ak"
    )


@pytest.mark.parametrize(
    "value", ["GUINEA-BISSAU", "united kingdom", "int'l falls", "st. paul", "", "Ünder ÖL", "a1b c"]
)
def test_title_case_is_that_of_python(spark, value):
    assert one(spark, text.title_case(F.col("v")), v=value) == value.title()


def test_md5_key(spark):
    import hashlib

    key = text.md5_key(F.col("a").cast("string"), F.col("b"))
    assert one(spark, key, a=5, b="x") == hashlib.md5(b"5x").hexdigest()


def test_code_labels(spark):
    assert one(spark, codes.code_label(F.col("v").cast("int"), codes.ARRIVAL_MODES), v=9) == (
        "Not reported"
    )
    assert one(spark, codes.code_label(F.col("v").cast("int"), codes.ARRIVAL_MODES), v=7) is None
    assert one(spark, codes.code_label(F.col("v"), codes.STATES, "?"), v="TX") == "TEXAS"
    assert one(spark, codes.state_code(F.col("v")), v="XX") == "99"
    assert len(codes.STATES) == 55
