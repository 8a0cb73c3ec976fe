"""The reports on both stars.

Facts are counted per key before they meet a dimension, so only one row per key is shuffled
or joined, whatever the share of the hottest key.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from starloom.operators.aggregates import counts_with_names, median_by_group, rows_at_max, top_k
from starloom.operators.cleaning import latest_window, lookup
from starloom.session import written


# --- plays ---

def top_artists(songplays: DataFrame, artists: DataFrame, k: int = 20) -> DataFrame:
    plays = counts_with_names(
        songplays, "artist_id", artists, "artist_id", ["artist_name"], "artist_plays"
    )
    return top_k(plays, "artist_plays", k, ["artist_name"])


def matched_plays(songplays: DataFrame, missing: str = "None") -> DataFrame:
    """Plays whose song is known; NULL and the text 'None' both count as unknown."""
    return songplays.where(F.col("song_id") != missing)


def song_plays_chain(
    songplays: DataFrame, songs: DataFrame, artists: DataFrame, k: int = 20, ascending: bool = True
) -> DataFrame:
    """Plays per (title, artist); the artist is reached through the song."""
    counts = songplays.where("song_id is not null").groupBy("song_id").agg(F.count("*").alias("_n"))
    titles = songs.select("song_id", "title", "artist_id")
    names = artists.select("artist_id", "artist_name")
    plays = (
        counts.join(titles, "song_id").join(names, "artist_id")
        .groupBy("title", "artist_name").agg(F.sum("_n").alias("total_plays"))
    )
    return top_k(plays, "total_plays", k, ["title", "artist_name"], ascending)


def top_locations(songplays: DataFrame, k: int = 10) -> DataFrame:
    plays = songplays.groupBy("location").agg(F.count("location").alias("plays"))
    return top_k(plays, "plays", k, ["location"])


def plays_on_day(songplays: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Plays on one day: a range of times, and the month's folder if the fact has such."""
    begin = datetime(year, month, day)
    bounds = [F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (begin, begin + timedelta(days=1))]
    time = F.col("start_time")
    rows = songplays.where((time >= bounds[0]) & (time < bounds[1]))
    if {"year", "month"} <= set(songplays.columns):
        rows = rows.where((F.col("year") == year) & (F.col("month") == month))
    return rows.agg(F.count("start_time").alias("plays"))


def plays_at(songplays: DataFrame, times: DataFrame, **parts: int) -> DataFrame:
    """Plays at times with these calendar parts, such as a weekday, which are no range.

    Plays are counted per time before they meet the time dimension.
    """
    counts = songplays.groupBy("start_time").agg(F.count("*").alias("_n"))
    joined = counts.join(lookup(times, **parts).select("start_time"), "start_time")
    return joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("plays"))


def years_with_most_titles(songs: DataFrame, k: int = 5) -> DataFrame:
    titles = songs.groupBy("year").agg(F.count_distinct("title").alias("titles"))
    return top_k(titles, "titles", k, ["year"])


def top_songs(
    songplays: DataFrame, songs: DataFrame, artists: DataFrame, k: int = 5
) -> DataFrame:
    """Songs with most plays: the fact joined with songs and with artists on its own ids."""
    counts = (
        songplays.where("song_id is not null and artist_id is not null")
        .groupBy("song_id", "artist_id").agg(F.count("*").alias("_n"))
    )
    plays = (
        counts.join(songs.select("song_id", "title"), "song_id")
        .join(artists.select("artist_id", "artist_name"), "artist_id")
        .groupBy("title", "artist_name").agg(F.sum("_n").alias("plays"))
    )
    return top_k(plays, "plays", k, ["title", "artist_name"])


def top_songs_latest(
    songplays: DataFrame, songs: DataFrame, artists: DataFrame, k: int = 5,
    interval: str = "1 week",
) -> DataFrame:
    """The same over the newest interval of the data."""
    return top_songs(latest_window(songplays, "start_time", interval), songs, artists, k)


def song_by_session_item(table: DataFrame, session_id: int, item: int) -> DataFrame:
    hit = lookup(table, session_id=session_id, item_in_session=item)
    return hit.select("artist", "song", "duration")


def session_history(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    rows = lookup(table, user_id=user_id, session_id=session_id)
    return rows.orderBy("item_in_session").select(
        "item_in_session", "artist", "song", "first_name", "last_name"
    )


def users_by_song(table: DataFrame, song: str) -> DataFrame:
    return lookup(table, song=song).select("user_id", "first_name", "last_name")


# --- arrivals ---

def _arrivals(fact: DataFrame, group: list[str]) -> DataFrame:
    return fact.groupBy(*group).agg(F.count("*").alias("arrivals"))


def top_city_per_month(fact: DataFrame) -> DataFrame:
    """The port(s) with most arrivals of every month."""
    return rows_at_max(_arrivals(fact, ["year", "month", "port_code"]), ["year", "month"], "arrivals")


def top_month_per_city(fact: DataFrame) -> DataFrame:
    """The calendar month(s) with most arrivals of every port."""
    return rows_at_max(_arrivals(fact, ["port_code", "month"]), ["port_code"], "arrivals")


def top_origin_per_city(fact: DataFrame) -> DataFrame:
    """The origin(s) of most arrivals of every port."""
    known = fact.where("origin_country is not null")
    return rows_at_max(_arrivals(known, ["port_code", "origin_country"]), ["port_code"], "arrivals")


def top_cities_for_origin(fact: DataFrame, origin: str, k: int = 10) -> DataFrame:
    visits = _arrivals(fact.where(F.col("origin_country") == origin), ["port_code"])
    return top_k(visits, "arrivals", k, ["port_code"])


def hot_cold_month_delta(fact: DataFrame) -> DataFrame:
    """Arrivals in the hottest minus the coldest month of a year, per year.

    A month's temperature is the mean over its arrivals; ties go to the earlier month.
    """
    months = fact.groupBy("year", "month").agg(
        F.count("*").alias("arrivals"), F.round(F.avg("temperature_avg"), 6).alias("t")
    )
    per_year = months.groupBy("year").agg(
        F.min(F.struct(-F.col("t"), "month", "arrivals")).alias("hot"),
        F.min(F.struct("t", "month", "arrivals")).alias("cold"),
    )
    return per_year.select(
        "year",
        F.col("hot.month").alias("hottest_month"),
        F.col("cold.month").alias("coldest_month"),
        (F.col("hot.arrivals") - F.col("cold.arrivals")).alias("arrivals_delta"),
    )


def _age_counts(fact: DataFrame) -> DataFrame:
    """Arrivals and the sum of their temperatures per (port, age)."""
    return fact.groupBy("port_code", "age").agg(
        F.count("*").alias("n"),
        F.count("temperature_avg").alias("n_t"),
        F.sum("temperature_avg").alias("t"),
    )


def _age_means(counts: DataFrame, at_least: float | None, below: float | None) -> DataFrame:
    """Mean age of the ports whose mean temperature is within the bounds."""
    known = F.when(F.col("age").isNotNull(), F.col("n"))
    means = counts.groupBy("port_code").agg(
        (F.sum("t") / F.sum("n_t")).alias("_t"),
        F.round(F.sum(F.col("age") * F.col("n")) / F.sum(known), 6).alias("avg_age"),
    )
    if at_least is not None:
        means = means.where(F.col("_t") >= at_least)
    if below is not None:
        means = means.where(F.col("_t") < below)
    return means.select("port_code", "avg_age")


def ages_by_temperature(
    fact: DataFrame, at_least: float | None = None, below: float | None = None
) -> DataFrame:
    """Mean and median age of arrivals per port whose mean temperature is within bounds.

    The fact is read once, for the counts per (port, age); all the rest comes from them.
    """
    counts = written(_age_counts(fact), "age-counts")
    means = _age_means(counts, at_least, below)
    medians = median_by_group(counts, ["port_code"], "age", "median_age", weight="n")
    return means.join(medians, "port_code")


def mean_age_by_temperature(
    fact: DataFrame, at_least: float | None = None, below: float | None = None
) -> DataFrame:
    return _age_means(_age_counts(fact), at_least, below)


def origins_of_youngest_cities(fact: DataFrame, cities: int = 5, k: int = 10) -> DataFrame:
    """Origins with most arrivals in the ports with the lowest median age."""
    ages = fact.groupBy("port_code").agg(F.min("city_median_age").alias("age"))
    youngest = top_k(ages, "age", cities, ["port_code"], ascending=True).select("port_code")
    known = fact.where("origin_country is not null")
    counts = _arrivals(known, ["port_code", "origin_country"])
    visits = counts.join(youngest, "port_code", "left_semi")
    totals = visits.groupBy("origin_country").agg(F.sum("arrivals").alias("arrivals"))
    return top_k(totals, "arrivals", k, ["origin_country"])


def months_of_older_cities(fact: DataFrame, min_age: float, k: int = 12) -> DataFrame:
    """Calendar months by arrivals in cities whose median age is at least `min_age`."""
    visits = _arrivals(fact.where(F.col("city_median_age") >= min_age), ["month"])
    return top_k(visits, "arrivals", k, ["month"])
