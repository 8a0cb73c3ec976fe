"""The reports on both stars."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.matching import match_plays
from starloom.plans import analytics, query_tables
from starloom.operators.tables import write_table
from starloom.plans.plays import (
    build_artists, build_songs, build_times, partitioned_by_month, plays_of,
)
from starloom.functions.timeparts import start_time
from starloom.queries import shapes
from starloom.queries.joins import FIRST_SQL
from starloom.queries.registry import query
from starloom.queries.stars import ARRIVALS_STAR, ONE, SECONDS, arrivals_star

FACT_SQL = f"""WITH {shapes.PLAYS_CATALOG_SQL}, {FIRST_SQL}, fact AS (
  SELECT {SECONDS} AS start_time, song_id, artist_id, sessionId AS session_id, location
  FROM matched),
songs AS (SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog),
artists AS (SELECT DISTINCT artist_id, artist_name FROM catalog) """


def fact(t):
    """Plays with their first match, as the fact of the star without a surrogate key."""
    matched = match_plays(plays_of(shapes.play_log(t)), shapes.catalog(t), pick="first")
    return matched.select(
        start_time(F.col("ts")).alias("start_time"), "song_id", "artist_id",
        F.col("sessionId").alias("session_id"), "location",
    )


def written_fact(t):
    """The fact as it is stored, in folders by month."""
    path = t.folder("fact-by-month")
    write_table(partitioned_by_month(fact(t)), path, ["year", "month"])
    return t.spark.read.parquet(path)


def dims(t):
    """Songs, and artists with one row per id."""
    records = shapes.catalog(t)
    return build_songs(records), build_artists(records, "coalesce")


@query(
    "q_top_artists",
    FACT_SQL + "SELECT artist_name, count(fact.artist_id) AS artist_plays FROM fact "
    "JOIN artists USING (artist_id) GROUP BY artist_name "
    "ORDER BY artist_plays DESC, artist_name LIMIT 20",
)
def q_top_artists(t):
    return analytics.top_artists(fact(t), dims(t)[1])


@query("q_matched_plays", FACT_SQL + "SELECT * FROM fact WHERE song_id <> 'None'")
def q_matched_plays(t):
    return analytics.matched_plays(fact(t))


CHAIN_SQL = FACT_SQL + """SELECT title, artist_name, count(fact.song_id) AS total_plays FROM fact
JOIN songs ON fact.song_id = songs.song_id JOIN artists ON songs.artist_id = artists.artist_id
GROUP BY artist_name, title """


@query("q_top_songs_chain", CHAIN_SQL + "ORDER BY total_plays, title, artist_name LIMIT 20")
def q_top_songs_chain(t):
    return analytics.song_plays_chain(fact(t), *dims(t))


@query(
    "q_top_songs_chain_desc",
    CHAIN_SQL + "ORDER BY total_plays DESC, title, artist_name LIMIT 20",
)
def q_top_songs_chain_desc(t):
    return analytics.song_plays_chain(fact(t), *dims(t), ascending=False)


@query(
    "q_top_locations",
    FACT_SQL + "SELECT location, count(location) AS plays FROM fact GROUP BY location "
    "ORDER BY plays DESC, location LIMIT 10",
)
def q_top_locations(t):
    return analytics.top_locations(fact(t))


@query(
    "q_plays_on_day",
    FACT_SQL + "SELECT count(start_time) AS plays FROM fact WHERE year(start_time) = 1998 "
    "AND month(start_time) = 11 AND day(start_time) = 21",
)
def q_plays_on_day(t):
    return analytics.plays_on_day(written_fact(t), 1998, 11, 21)


@query(
    "q_plays_on_weekday",
    FACT_SQL + "SELECT count(start_time) AS plays FROM fact WHERE dayofweek(start_time) = 6 "
    "AND hour(start_time) = 11",
)
def q_plays_on_weekday(t):
    """Calendar parts that are no range go through the time dimension."""
    times = build_times(plays_of(shapes.play_log(t)))
    return analytics.plays_at(fact(t), times, weekday=6, hour=11)


@query(
    "q_years_most_titles",
    f"WITH {shapes.CATALOG_SQL} SELECT year, count(DISTINCT title) AS titles FROM catalog "
    "GROUP BY year ORDER BY titles DESC, year LIMIT 5",
)
def q_years_most_titles(t):
    return analytics.years_with_most_titles(dims(t)[0])


TOP_SQL = """SELECT title, artist_name, count(*) AS plays FROM {fact}
JOIN songs ON fact.song_id = songs.song_id JOIN artists ON fact.artist_id = artists.artist_id
GROUP BY title, artist_name ORDER BY plays DESC, title, artist_name LIMIT 5"""


@query("q_top_songs", FACT_SQL + TOP_SQL.format(fact="fact"))
def q_top_songs(t):
    return analytics.top_songs(fact(t), *dims(t))


@query(
    "q_top_songs_latest_week",
    FACT_SQL + TOP_SQL.format(
        fact="(SELECT * FROM fact WHERE start_time BETWEEN (SELECT max(start_time) FROM fact) "
             "- INTERVAL '1 week' AND (SELECT max(start_time) FROM fact)) AS fact"
    ),
)
def q_top_songs_latest_week(t):
    return analytics.top_songs_latest(written_fact(t), *dims(t))


# --- query tables, built from the whole log and looked up by key ---

def _typed(t):
    return query_tables.typed_plays(shapes.play_log(t))


_NEWEST = """FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, {rest})
  AS rn FROM plays) WHERE rn = 1 AND {where}"""


@query(
    "q_song_by_session_item",
    f"WITH {shapes.PLAYS_SQL} SELECT artist, song, cast(cast(length AS decimal(15,5)) AS double) "
    "AS duration " + _NEWEST.format(
        key="sessionId, itemInSession", rest="artist DESC, song DESC, length DESC",
        where="sessionId = 1046 AND itemInSession = 2",
    ),
)
def q_song_by_session_item(t):
    table = query_tables.song_by_item_in_session(_typed(t))
    hit = analytics.song_by_session_item(table, 1046, 2)
    return hit.withColumn("duration", F.col("duration").cast("double"))


@query(
    "q_session_history",
    f"WITH {shapes.PLAYS_SQL} SELECT itemInSession AS item_in_session, artist, song, firstName AS "
    "first_name, lastName AS last_name " + _NEWEST.format(
        key="userId, sessionId, itemInSession", rest="artist DESC, song DESC",
        where="userId = '{user}' AND sessionId = {session}",
    ).format(user=681, session=1046),
)
def q_session_history(t):
    table = query_tables.history_by_session(_typed(t))
    return analytics.session_history(table, 681, 1046)


@query(
    "q_users_by_song",
    f"WITH {shapes.PLAYS_SQL} SELECT DISTINCT cast(userId AS int) AS user_id, firstName AS "
    "first_name, lastName AS last_name FROM plays WHERE song = 'Song 10'",
)
def q_users_by_song(t):
    return analytics.users_by_song(query_tables.users_by_song(_typed(t)), "Song 10")


# --- arrivals ---

STAR = ARRIVALS_STAR.format(**ONE)


def _arrivals(t):
    return arrivals_star(t)["fact_immigrations"]


def _peak(group: str, item: str, where: str = "true") -> str:
    return STAR + f""", n AS (SELECT {group}, {item}, count(*) AS arrivals FROM fact_all
      WHERE {where} GROUP BY ALL)
    SELECT * EXCLUDE (rk) FROM (
      SELECT *, rank() OVER (PARTITION BY {group} ORDER BY arrivals DESC) AS rk FROM n) WHERE rk = 1"""


@query("q_top_city_in_month", _peak("year, month", "port_code"))
def q_top_city_in_month(t):
    return analytics.top_city_per_month(_arrivals(t))


@query("q_top_month_for_city", _peak("port_code", "month"))
def q_top_month_for_city(t):
    return analytics.top_month_per_city(_arrivals(t))


@query(
    "q_top_origin_for_city", _peak("port_code", "origin_country", "origin_country IS NOT NULL")
)
def q_top_origin_for_city(t):
    return analytics.top_origin_per_city(_arrivals(t))


@query(
    "q_top_cities_for_origin",
    STAR + "SELECT port_code, count(*) AS arrivals FROM fact_all WHERE origin_country = 'Nation 3' "
    "GROUP BY port_code ORDER BY arrivals DESC, port_code LIMIT 10",
)
def q_top_cities_for_origin(t):
    return analytics.top_cities_for_origin(_arrivals(t), "Nation 3")


@query(
    "q_hot_cold_month_delta",
    STAR + """, m AS (SELECT year, month, count(*) AS arrivals, round(avg(temperature_avg), 6) AS t
                      FROM fact_all GROUP BY year, month),
    r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY t DESC, month) AS hot,
                 row_number() OVER (PARTITION BY year ORDER BY t, month) AS cold FROM m)
    SELECT h.year, h.month AS hottest_month, c.month AS coldest_month,
           h.arrivals - c.arrivals AS arrivals_delta
    FROM r h JOIN r c ON h.year = c.year WHERE h.hot = 1 AND c.cold = 1""",
)
def q_hot_cold_month_delta(t):
    return analytics.hot_cold_month_delta(_arrivals(t))


HOT = 2500.0
AGES = STAR + """SELECT port_code, round(avg(age), 6) AS avg_age{median} FROM fact_all
GROUP BY port_code HAVING avg(temperature_avg) {bound}"""


@query(
    "q_age_hot_cities",
    AGES.format(median=", cast(median(age) AS double) AS median_age", bound=f">= {HOT}"),
)
def q_age_hot_cities(t):
    return analytics.ages_by_temperature(_arrivals(t), at_least=HOT, below=None)


@query("q_age_cold_cities", AGES.format(median="", bound=f"< {HOT}"))
def q_age_cold_cities(t):
    return analytics.mean_age_by_temperature(_arrivals(t), below=HOT)


@query(
    "q_origins_youngest_cities",
    STAR + """, young AS (SELECT port_code FROM fact_all GROUP BY port_code
      ORDER BY min(city_median_age), port_code LIMIT 5)
    SELECT origin_country, count(*) AS arrivals FROM fact_all
    WHERE port_code IN (SELECT port_code FROM young) AND origin_country IS NOT NULL
    GROUP BY origin_country ORDER BY arrivals DESC, origin_country LIMIT 10""",
)
def q_origins_youngest_cities(t):
    return analytics.origins_of_youngest_cities(_arrivals(t))


@query(
    "q_months_older_cities",
    STAR + "SELECT month, count(*) AS arrivals FROM fact_all WHERE city_median_age >= 40 "
    "GROUP BY month ORDER BY arrivals DESC, month LIMIT 12",
)
def q_months_older_cities(t):
    return analytics.months_of_older_cities(_arrivals(t), 40)
