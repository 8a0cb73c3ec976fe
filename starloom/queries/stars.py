"""Star builds and incremental runs: one query per output table."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.contracts import SONG_CATALOG, USERS
from starloom.operators.merge import last_wins
from starloom.operators.snapshots import merge_snapshot, read_snapshot
from starloom.operators.tables import filesystem, packed, write_json
from starloom.plans import arrivals, catalogs, plays, query_tables, refresh
from starloom.queries import shapes
from starloom.queries.joins import DIMS_SQL, FIRST_SQL, TEMP_SQL
from starloom.queries.registry import query
from starloom.queries.scans import EVENTS, EVENTS_SQL
from starloom.sources.files import country_codes, port_codes, scan_json, typed_arrivals
from starloom.streaming.incremental import run_incremental

PC = f"WITH {shapes.PLAYS_CATALOG_SQL}"
SECONDS = "make_timestamp((ts // 1000) * 1000000)"
MILLIS = "make_timestamp(ts * 1000)"


# --- catalog dimensions ---

@query(
    "pipe_song_dims",
    f"""WITH {shapes.CATALOG_SQL}
    SELECT song_id, arg_min(title, _order) AS title, arg_min(artist_id, _order) AS artist_id,
           CASE WHEN arg_min(year, _order) = 0
                THEN coalesce(arg_min(year, _order) FILTER (WHERE year > 0), 0)
                ELSE arg_min(year, _order) END AS year,
           arg_min(duration, _order) AS duration
    FROM catalog GROUP BY song_id""",
)
def pipe_song_dims(t):
    return plays.build_song_dims(shapes.catalog(t), plays.UPSERT)["songs"]


@query(
    "pipe_song_dims_artists",
    f"""WITH {shapes.CATALOG_SQL}
    SELECT artist_id, arg_min(artist_name, _order) AS artist_name,
           arg_max(artist_location, _order) FILTER (WHERE trim(artist_location) <> '')
             AS artist_location,
           arg_max(artist_latitude, _order) FILTER (WHERE artist_latitude IS NOT NULL)
             AS artist_latitude,
           arg_max(artist_longitude, _order) FILTER (WHERE artist_longitude IS NOT NULL)
             AS artist_longitude
    FROM catalog GROUP BY artist_id""",
)
def pipe_song_dims_artists(t):
    return plays.build_song_dims(shapes.catalog(t), plays.UPSERT)["artists"]


SONGS_ARRIVED_SQL = """SELECT song_id, arg_min(title, _order) AS title, arg_min(artist_id, _order) AS artist_id,
           CASE WHEN arg_min(year, _order) = 0
                THEN coalesce(arg_min(year, _order) FILTER (WHERE year > 0), 0)
                ELSE arg_min(year, _order) END AS year,
           cast(arg_min(duration, _order) AS double) AS duration
    FROM arrived GROUP BY song_id"""


ARTISTS_ARRIVED_SQL = """SELECT artist_id, arg_min(artist_name, _order) AS artist_name,
           arg_max(artist_location, _order) FILTER (WHERE trim(artist_location) <> '')
             AS artist_location,
           arg_max(artist_latitude, _order) FILTER (WHERE artist_latitude IS NOT NULL)
             AS artist_latitude,
           arg_max(artist_longitude, _order) FILTER (WHERE artist_longitude IS NOT NULL)
             AS artist_longitude
    FROM arrived GROUP BY artist_id"""


@query("pipe_song_dims_repeated", f"WITH {shapes.ARRIVED_SQL} {SONGS_ARRIVED_SQL}")
def pipe_song_dims_repeated(t):
    """Songs that arrive several times, with other titles, artists, years and durations."""
    return plays.build_song_dims(shapes.arrived_catalog(t), plays.UPSERT)["songs"]


def _arrived_files(t):
    """The same records as three drops, each of many files whose paths follow the order and which
    have one time, with folder names that agree with the order of the drops only in part."""
    root = t.folder("arrived")
    rows = shapes.arrived_catalog(t)
    for part in range(3):
        drop = f"{root}/{'cab'[part]}"
        rows.where(F.pmod("_order", F.lit(3)) == part).orderBy("_order").drop("_order").write.json(drop)
        fs, folder = filesystem(t.spark, drop)
        for status in fs.listStatus(folder):
            fs.setTimes(status.getPath(), 1_600_000_000_000 + part * 1000, -1)
    return scan_json(t.spark, root, SONG_CATALOG, arrival=True)


_FILE_ORDER = shapes.ARRIVED_SQL.replace("p_partkey AS _order", "[p_partkey % 3, p_partkey] AS _order")


@query("pipe_song_dims_files", f"WITH {_FILE_ORDER} {SONGS_ARRIVED_SQL}")
def pipe_song_dims_files(t):
    """The order of arrival comes from the files: one after the other, line by line."""
    return plays.build_song_dims(_arrived_files(t), plays.UPSERT)["songs"]


@query("pipe_song_dims_artists_files", f"WITH {_FILE_ORDER} {ARTISTS_ARRIVED_SQL}")
def pipe_song_dims_artists_files(t):
    return plays.build_song_dims(_arrived_files(t), plays.UPSERT)["artists"]


@query(
    "pipe_song_dims_artists_distinct",
    f"WITH {shapes.CATALOG_SQL}, {DIMS_SQL} SELECT * FROM artists",
)
def pipe_song_dims_artists_distinct(t):
    return plays.build_song_dims(shapes.catalog(t), plays.LAKE)["artists"]


# --- play star ---

def _star(t, preset):
    return plays.build_play_star(shapes.play_log(t), shapes.catalog(t), preset)


def _fact_sql(source: str, start: str, distinct: bool = False, artist: str = "artist_id") -> str:
    return f"""SELECT {"DISTINCT" if distinct else ""} {start} AS start_time,
      cast(userId AS int) AS user_id, level, song_id, {artist} AS artist_id,
      sessionId AS session_id, location, userAgent AS user_agent FROM {source}"""


ORDER = ("start_time, session_id, user_id, level, song_id NULLS FIRST, artist_id NULLS FIRST, "
         "location, user_agent")


@query(
    "pipe_play_star",
    f"""{PC}, {FIRST_SQL}, fact AS ({_fact_sql("matched", MILLIS)})
    SELECT row_number() OVER (ORDER BY {ORDER}) AS songplay_id, * FROM fact""",
)
def pipe_play_star(t):
    """The fact with first matches and dense keys."""
    return _star(t, plays.UPSERT)["songplays"]


@query(
    "pipe_play_star_warehouse",
    f"""{PC}, fact AS ({_fact_sql(
        "plays JOIN catalog ON song = title AND artist = artist_name", SECONDS, True)})
    SELECT row_number() OVER (ORDER BY {ORDER}) - 1 AS songplay_id, * FROM fact""",
)
def pipe_play_star_warehouse(t):
    """The fact with all matches on title and artist, distinct in whole seconds."""
    return _star(t, plays.WAREHOUSE)["songplays"]


@query(
    "pipe_play_star_lake",
    f"""{PC}, {DIMS_SQL} {_fact_sql(
        "plays JOIN songs ON song = title JOIN artists ON artist = artist_name",
        SECONDS, True, "artists.artist_id")}""",
)
def pipe_play_star_lake(t):
    """The fact matched in two steps; its ids are unique but not stable, so they are dropped."""
    return _star(t, plays.LAKE)["songplays"].drop("songplay_id")


@query(
    "pipe_play_star_scheduled",
    f"""{PC}, fact AS ({_fact_sql(
        "plays LEFT JOIN catalog ON song = title AND artist = artist_name "
        "AND trunc(length)::bigint = trunc(duration)::bigint", SECONDS)})
    SELECT md5(session_id || strftime(start_time, '%Y-%m-%d %H:%M:%S')) AS songplay_id, *
    FROM fact""",
)
def pipe_play_star_scheduled(t):
    """The fact with unmatched plays kept and hashed keys."""
    return _star(t, plays.SCHEDULED)["songplays"]


def _from_files(t, preset, staged):
    """The star from JSON folders, as a job runs it."""
    root = t.folder("star-from-files")
    write_json(shapes.play_log(t), f"{root}/log", compressed=True)
    write_json(shapes.catalog(t).drop("_order"), f"{root}/songs")
    paths = plays.run_play_star(
        t.spark, f"{root}/log", f"{root}/songs", f"{root}/out", preset, staged
    )
    return t.spark.read.parquet(paths["songplays"])


_MONTHS = "year(start_time)::int AS year, month(start_time)::int AS month"


# The key of one row: session, second, item and song.
ROW_KEY = ("md5(concat_ws('|', session_id, strftime(start_time, '%Y-%m-%d %H:%M:%S'), itemInSession, "
           "coalesce(song_id, '-')))")


def _keyed_fact_sql(source: str, distinct: bool = False) -> str:
    fact = _fact_sql(source, SECONDS, distinct).replace(" FROM ", ", itemInSession FROM ", 1)
    return f"SELECT {ROW_KEY} AS songplay_id, * EXCLUDE (itemInSession), {_MONTHS} FROM ({fact})"


@query(
    "pipe_play_star_files",
    f"{PC}, {FIRST_SQL} {_keyed_fact_sql('matched', True)}",
)
def pipe_play_star_files(t):
    return _from_files(t, plays.DEFAULT, staged=False)


@query(
    "pipe_play_star_staged",
    f"""{PC}, fact AS ({_fact_sql(
        "plays JOIN catalog ON song = title AND artist = artist_name", SECONDS, True)})
    SELECT row_number() OVER (ORDER BY {ORDER}) - 1 AS songplay_id, *, {_MONTHS} FROM fact""",
)
def pipe_play_star_staged(t):
    """The same through the staging load, with the warehouse's semantics."""
    return _from_files(t, plays.WAREHOUSE, staged=True)


@query(
    "pipe_play_star_report",
    """SELECT preset, table_name, check_name, 0::BIGINT AS violations FROM (VALUES """
    + ", ".join(
        f"('{preset}', '{table}', '{check}')"
        for preset in plays.PRESETS for table, check in plays.report_names(plays.PRESETS[preset])
    ) + ") AS v(preset, table_name, check_name)",
)
def pipe_play_star_report(t):
    """All checks of the contracts of the written star, under every preset, as they are made of the
    tables before these get their names."""
    root = t.folder("reported")
    write_json(shapes.play_log(t), f"{root}/log", compressed=True)
    write_json(shapes.catalog(t).drop("_order"), f"{root}/songs")
    log, songs = f"{root}/log", f"{root}/songs"
    reports: list[DataFrame] = []
    with plays.stored_inputs(t.spark, log, songs) as inputs:
        for preset in plays.PRESETS.values():
            plays.run_play_star(
                t.spark, log, songs, f"{root}/{len(reports)}", preset, inputs=inputs, reports=reports)
    named = [r.select(F.lit(name).alias("preset"), "*") for name, r in zip(plays.PRESETS, reports)]
    return reduce(DataFrame.unionByName, named)


USERS_SQL = """SELECT user_id, arg_max(first_name, r) AS first_name, arg_max(last_name, r)
  AS last_name, arg_max(gender, r) AS gender, arg_max(level, r) AS level FROM (
  SELECT cast(userId AS int) AS user_id, firstName AS first_name, lastName AS last_name, gender,
         level, ts, itemInSession, (ts, itemInSession, firstName, lastName, gender, level) AS r
  FROM plays) GROUP BY user_id"""


@query("pipe_play_star_users", f"WITH {shapes.PLAYS_SQL} {USERS_SQL}")
def pipe_play_star_users(t):
    return plays.build_users(plays.plays_of(shapes.play_log(t)), plays.UPSERT.users)


@query(
    "pipe_play_star_users_distinct",
    f"""WITH {shapes.PLAYS_SQL}
    SELECT DISTINCT cast(userId AS int) AS user_id, firstName AS first_name,
           lastName AS last_name, gender, level FROM plays""",
)
def pipe_play_star_users_distinct(t):
    return plays.build_users(plays.plays_of(shapes.play_log(t)), plays.LAKE.users)


def _times_sql(start: str, weekday: str) -> str:
    return f"""WITH {shapes.PLAYS_SQL}, s AS (SELECT DISTINCT {start} AS start_time FROM plays)
    SELECT start_time, hour(start_time)::int AS hour, day(start_time)::int AS day,
           week(start_time)::int AS week, month(start_time)::int AS month,
           year(start_time)::int AS year, {weekday} AS weekday FROM s"""


@query("pipe_play_star_times", _times_sql(MILLIS, "(isodow(start_time) - 1)::int"))
def pipe_play_star_times(t):
    preset = plays.UPSERT
    return plays.build_times(plays.plays_of(shapes.play_log(t)), preset.precision, preset.weekday)


@query("pipe_play_star_times_seconds", _times_sql(SECONDS, "dayofweek(start_time)::int"))
def pipe_play_star_times_seconds(t):
    preset = plays.WAREHOUSE
    return plays.build_times(plays.plays_of(shapes.play_log(t)), preset.precision, preset.weekday)


# --- query tables ---

def event_csv(t) -> str:
    """The play log as CSV files."""
    path = t.folder("event-csv")
    log = shapes.play_log(t).select(*[
        "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level",
        "location", "method", "page", "registration", "sessionId", "song", "status", "ts", "userId",
    ])
    packed(log.write).option("header", True).option("escape", '"').csv(path)
    return path


def _keyed_sql(key: list[str], values: dict[str, str]) -> str:
    names = {
        "session_id": "cast(sessionId AS int)", "item_in_session": "itemInSession",
        "user_id": "cast(userId AS int)", "artist": "artist", "song": "song",
        "duration": "cast(length AS decimal(15,5))", "first_name": "firstName",
        "last_name": "lastName",
    }
    picked = ", ".join(
        f"{cast.format(c=f'arg_max({c}, r)')} AS {c}" for c, cast in values.items()
    )
    inner = ", ".join(f"{names[c]} AS {c}" for c in [*key, *values])
    rank = ", ".join(["cast(ts AS double)", *[names[c] for c in values]])
    return f"""WITH {shapes.PLAYS_SQL}
    SELECT {', '.join(key)}, {picked} FROM (SELECT {inner}, ({rank}) AS r FROM plays)
    GROUP BY {', '.join(key)}"""


def _query_table(t, name):
    paths = query_tables.run_query_tables(t.spark, event_csv(t), t.folder("query-tables"))
    return t.spark.read.parquet(paths[name])


@query(
    "pipe_query_tables",
    _keyed_sql(["session_id", "item_in_session"],
               {"artist": "{c}", "song": "{c}", "duration": "cast({c} AS double)"}),
)
def pipe_query_tables(t):
    table = _query_table(t, "song_by_item_in_session")
    return table.withColumn("duration", F.col("duration").cast("double"))


@query(
    "pipe_query_tables_history",
    _keyed_sql(["user_id", "session_id", "item_in_session"],
               {"artist": "{c}", "song": "{c}", "first_name": "{c}", "last_name": "{c}"}),
)
def pipe_query_tables_history(t):
    return _query_table(t, "history_by_session")


@query(
    "pipe_query_tables_users",
    _keyed_sql(["song", "user_id"], {"first_name": "{c}", "last_name": "{c}"}),
)
def pipe_query_tables_users(t):
    return _query_table(t, "users_by_song")


# --- arrivals star ---

ARRIVALS_STAR = f"""WITH {TEMP_SQL}, {shapes.COUNTRIES_SQL}, {shapes.ARRIVALS_SQL},
dim_imm AS (
  SELECT cast(i94yr AS int) AS year, cast(i94mon AS int) AS month,
         cast(i94cit AS int) AS origin_country_code, i94port AS port_code,
         strftime(date '1960-01-01' + cast(arrdate AS int), '%Y-%m-%d') AS arr_date,
         strftime(date '1960-01-01' + cast(depdate AS int), '%Y-%m-%d') AS dep_date,
         cast(i94mode AS int) AS mode, i94addr AS addr_state_abbr, cast(i94bir AS int) AS age,
         cast(i94visa AS int) AS reason, cast(biryear AS int) AS birth_year, gender
  FROM arrivals
  WHERE i94addr IS NOT NULL AND depdate IS NOT NULL AND gender IS NOT NULL
    AND i94port IN (SELECT code FROM ports WHERE is_valid)
    AND cast(i94cit AS int) IN (SELECT code FROM countries WHERE is_valid)),
fact_all AS (
  SELECT i.year, i.month, upper(c.country[1]) || c.country[2:] AS origin_country, i.port_code,
         i.arr_date, i.dep_date, i.mode, i.addr_state_abbr, i.age, i.reason, i.gender,
         t.avg_temperature AS temperature_avg, d.median_age AS city_median_age,
         d.total_population AS city_total_population
  FROM dim_imm i JOIN {{temp}} t ON i.port_code = t.port_code AND i.month = t.m
  JOIN {{demo}} d ON i.port_code = d.port_code
  LEFT JOIN countries c ON origin_country_code = c.code)
"""
# One reading per port and month, and one city per port; or all of them.
ONE = {
    "temp": "(SELECT port_code, month(d) AS m, arg_max(avg_temperature, (d, avg_temperature)) "
            "AS avg_temperature FROM dim_temp GROUP BY ALL)",
    "demo": "(SELECT DISTINCT port_code, median_age, total_population FROM dim_demo)",
}
ALL = {"temp": "(SELECT *, month(d) AS m FROM dim_temp)", "demo": "dim_demo"}


def _arrival_inputs(t):
    return (
        typed_arrivals(shapes.arrivals(t)), shapes.temperatures(t), shapes.demographics(t),
        port_codes(shapes.port_lines(t)), country_codes(shapes.country_lines(t)),
    )


def arrivals_star(t, distinct=False):
    return arrivals.build_arrivals_star(*_arrival_inputs(t), distinct)


def _dates_as_text(df):
    return df.withColumns({
        f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.typeName() == "date"
    })


@query(
    "pipe_arrivals_star",
    ARRIVALS_STAR.format(**ONE) + "SELECT * FROM fact_all",
)
def pipe_arrivals_star(t):
    """The fact, as written and read back after the checks."""
    paths = arrivals.run_arrivals_star(*_arrival_inputs(t), t.folder("arrivals-star"))
    return _dates_as_text(t.spark.read.parquet(paths["fact_immigrations"]))


@query(
    "pipe_arrivals_star_distinct",
    ARRIVALS_STAR.format(**ALL) + "SELECT DISTINCT * FROM fact_all",
)
def pipe_arrivals_star_distinct(t):
    """The fact with race rows joined and merged by a distinct."""
    return _dates_as_text(arrivals_star(t, distinct=True)["fact_immigrations"])


@query(
    "pipe_arrivals_star_immigrations",
    ARRIVALS_STAR.format(**ALL) + "SELECT * FROM dim_imm",
)
def pipe_arrivals_star_immigrations(t):
    return _dates_as_text(arrivals_star(t)["dim_immigrations"])


@query(
    "pipe_arrivals_star_temperatures",
    f"WITH {TEMP_SQL} SELECT strftime(d, '%Y-%m-%d') AS date, avg_temperature, city, country, "
    "latitude, longitude, port_code FROM dim_temp",
)
def pipe_arrivals_star_temperatures(t):
    return _dates_as_text(arrivals_star(t)["dim_temperatures"])


@query("pipe_arrivals_star_demographics", f"WITH {TEMP_SQL} SELECT * FROM dim_demo")
def pipe_arrivals_star_demographics(t):
    return arrivals_star(t)["dim_city_demos"]


# --- the catalog as a stream of files ---

def _streamed_catalog(t, name):
    """The arrived catalog in three drops, the newest rows first, merged run by run."""
    root = t.folder("catalog-stream")
    rows = shapes.arrived_catalog(t)
    ordered = replace(SONG_CATALOG, columns=f"{SONG_CATALOG.columns}, _order bigint")
    for i in (2, 0, 1):
        write_json(rows.where(F.pmod("_order", F.lit(3)) == i), f"{root}/in/drop={i}")
        dims = catalogs.run_catalog(
            t.spark, f"{root}/in", root, order=["_order"], contract=ordered, buckets=8, files_per_batch=2)
    return dims[name]


@query("pipe_song_dims_stream", f"WITH {shapes.ARRIVED_SQL} {SONGS_ARRIVED_SQL}")
def pipe_song_dims_stream(t):
    return _streamed_catalog(t, "songs")


@query("pipe_song_dims_artists_stream", f"WITH {shapes.ARRIVED_SQL} {ARTISTS_ARRIVED_SQL}")
def pipe_song_dims_artists_stream(t):
    return _streamed_catalog(t, "artists")


# --- incremental ---

def _drop(rows, path):
    packed(rows.write.mode("append")).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).json(path)


@query("incremental_fact_append", EVENTS_SQL)
def incremental_fact_append(t):
    """Three file drops that overlap, one run after each."""
    root = t.folder("incremental-fact")
    source, fact, checkpoint = f"{root}/in", f"{root}/fact", f"{root}/_checkpoint"
    events = t("events")
    n = events.count()
    for low, high in ((0, n // 2), (n // 3, 3 * n // 4), (n // 2, n)):
        part = events.where(F.col("event_id").between(low, high - 1))
        _drop(part, f"{source}/drop={low}")
        run_incremental(
            t.spark, source, EVENTS, fact, checkpoint, key=["event_id"]
        )
    return t.spark.read.schema(EVENTS.schema).parquet(fact)


@query(
    "incremental_dim_refresh",
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, "
    "arg_max(value, (ts, event_id)) AS value, max(ts) AS ts, "
    "arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id",
)
def incremental_dim_refresh(t):
    """After each of three runs of several batches, in no order of time, the users are merged."""
    root = t.folder("incremental-dim")
    events = t("events")
    for i in (1, 2, 0):
        _drop(events.where(F.pmod("event_id", F.lit(3)) == i), f"{root}/in/drop={i}")
        run_incremental(
            t.spark, f"{root}/in", EVENTS, f"{root}/fact", f"{root}/_checkpoint",
            key=["event_id"], files_per_batch=2,
            collect=lambda batch: last_wins(
                batch.drop("props"), ["user_id"], ["ts", "event_id"], keep_order=True),
            refresh=lambda users: merge_snapshot(
                users, f"{root}/users", ["user_id"], ["ts", "event_id"], buckets=16, keep_order=True),
        )
    return read_snapshot(t.spark, f"{root}/users")


def _hourly(t, dirty=False, late=False):
    """Two drops of whole sessions, one run after each, and a third run without new files.

    With `dirty` there are lines that are cut short, blank lines and a blank column among them.
    With `late` two of three songs come to the catalog after the plays: one before the second
    run, one before the third.
    """
    root = t.folder("hourly")
    log, catalog = shapes.play_log(t), shapes.catalog(t)
    if dirty:
        log = log.withColumn("location", F.when(F.col("itemInSession") == 2, " ").otherwise(F.col("location")))
    for i in range(2):
        rows = log.where(F.pmod("sessionId", F.lit(2)) == i)
        if dirty:
            bad = F.col("itemInSession") == 3
            line = F.to_json(F.struct("*"))
            cut = F.when(bad, F.expr("substring(_line, 1, 40)")).otherwise(F.col("_line"))
            lines = rows.select("itemInSession", line.alias("_line")).select(
                F.explode(F.array(cut, F.lit("  "))).alias("value"))
            packed(lines.write.mode("append")).text(f"{root}/log/drop={i}")
        else:
            _drop(rows, f"{root}/log/drop={i}")
        known = catalog.where(F.pmod("_order", F.lit(3)) <= i) if late else catalog
        refresh.run_hourly(
            t.spark, f"{root}/log", known, f"{root}/out", max_error=10**9 if dirty else 0)
    return refresh.run_hourly(t.spark, f"{root}/log", catalog, f"{root}/out")


SCHEDULED_MATCH = ("{plays} LEFT JOIN catalog ON song = title AND artist = artist_name "
                   "AND trunc(length)::bigint = trunc(duration)::bigint")


@query("pipe_hourly_refresh", f"{PC} {_keyed_fact_sql(SCHEDULED_MATCH.format(plays='plays'))}")
def pipe_hourly_refresh(t):
    """Every play with every match, also after reruns."""
    return t.spark.read.parquet(_hourly(t)["songplays"])


@query("pipe_hourly_refresh_late", f"{PC} {_keyed_fact_sql(SCHEDULED_MATCH.format(plays='plays'))}")
def pipe_hourly_refresh_late(t):
    """Songs that come after their plays: the fact is as if all had been there from the start."""
    return t.spark.read.parquet(_hourly(t, late=True)["songplays"])


_CLEAN = """(SELECT * REPLACE (CASE WHEN itemInSession = 2 THEN NULL ELSE location END AS location)
  FROM plays WHERE itemInSession <> 3) AS p"""


@query("pipe_hourly_refresh_dirty", f"{PC} {_keyed_fact_sql(SCHEDULED_MATCH.format(plays=_CLEAN))}")
def pipe_hourly_refresh_dirty(t):
    """Lines that cannot be loaded are counted and left out; blank values are null."""
    return t.spark.read.parquet(_hourly(t, dirty=True)["songplays"])


@query(
    "pipe_hourly_refresh_users",
    f"""WITH {shapes.PLAYS_SQL}
    SELECT user_id, arg_max(first_name, r) AS first_name, arg_max(last_name, r) AS last_name,
           arg_max(gender, r) AS gender, arg_max(level, r) AS level FROM (
      SELECT cast(userId AS int) AS user_id, firstName AS first_name, lastName AS last_name,
             gender, level, (ts, itemInSession, firstName, lastName, gender, level) AS r FROM plays)
    GROUP BY user_id""",
)
def pipe_hourly_refresh_users(t):
    return read_snapshot(t.spark, _hourly(t)["users"]).select(*USERS.column_names)


@query("pipe_hourly_refresh_times", _times_sql(SECONDS, "dayofweek(start_time)::int"))
def pipe_hourly_refresh_times(t):
    return t.spark.read.parquet(_hourly(t)["times"])
