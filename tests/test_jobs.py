"""The command line jobs on small folders."""

import json

import pytest

from starloom import jobs
from tests.test_plays import T0, event
from tests.test_sources import COUNTRIES, PORTS


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "log" / "2018" / "11").mkdir(parents=True)
    log = [event(T0), event(T0 + 60_000, item=1, song="none"), event(T0 + 90_000, item=2, page="Home")]
    (tmp_path / "log" / "2018" / "11" / "a.json").write_text(
        "".join(json.dumps(row) + "\n" for row in log)
    )
    (tmp_path / "songs" / "A").mkdir(parents=True)
    (tmp_path / "songs" / "A" / "s.json").write_text(json.dumps(dict(
        num_songs=1, artist_id="A1", artist_latitude=None, artist_longitude=None,
        artist_location="", artist_name="A", song_id="S1", title="T", duration=246.9, year=0,
    )))
    return tmp_path


def count(spark, path):
    return spark.read.parquet(path).count()


@pytest.mark.parametrize("extra, plays", [
    (["--preset", "default"], 2), (["--preset", "lake"], 1), (["--preset", "upsert"], 2),
    (["--preset", "warehouse", "--staged"], 1), (["--preset", "scheduled", "--staged"], 2),
])
def test_star(spark, inputs, extra, plays):
    paths = jobs.main([
        "star", "--log", f"{inputs}/log", "--songs", f"{inputs}/songs", "--out", f"{inputs}/out",
        *extra,
    ])
    assert count(spark, paths["songplays"]) == plays
    assert [count(spark, paths[t]) for t in ("users", "songs", "artists", "times")] == [1, 1, 1, 2]


def test_refresh(spark, inputs):
    argv = ["refresh", "--log", f"{inputs}/log", "--songs", f"{inputs}/songs", "--out",
            f"{inputs}/out"]
    jobs.main(argv)
    paths = jobs.main(argv)
    assert count(spark, paths["songplays"]) == 2


def test_arrivals(spark, inputs):
    (inputs / "ports.txt").write_text(PORTS)
    (inputs / "countries.txt").write_text(COUNTRIES)
    (inputs / "t.csv").write_text(
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "2013-04-01,12.5,0.2,Alcan,United States,62N,141W\n"
    )
    (inputs / "d.csv").write_text(
        "City;State;Median Age;Male Population;Female Population;Total Population;"
        "Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count\n"
        "Alcan;Alaska;36.7;1;2;3;4;5;2.4;AK;White;6\nAlcan;Alaska;36.7;1;2;3;4;5;2.4;AK;Asian;1\n"
    )
    spark.sql(
        "SELECT 2016.0D i94yr, 4.0D i94mon, 236.0D i94cit, 'ALC' i94port, 20545.0D arrdate, "
        "3.0D i94mode, 'AK' i94addr, 20555.0D depdate, 30.0D i94bir, 2.0D i94visa, "
        "1986.0D biryear, 'F' gender"
    ).write.parquet(f"{inputs}/apr16")
    paths = jobs.main([
        "arrivals", "--arrivals", f"{inputs}/apr16", "--temperatures", f"{inputs}/t.csv",
        "--demographics", f"{inputs}/d.csv", "--ports", f"{inputs}/ports.txt",
        "--countries", f"{inputs}/countries.txt", "--out", f"{inputs}/out",
    ])
    row = spark.read.parquet(paths["fact_immigrations"]).first()
    assert (row.origin_country, row.temperature_avg, row.city_median_age) == ("Afghanistan", 12.5, 36.7)
