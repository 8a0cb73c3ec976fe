"""Joins and catalog matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import aggregates, lookups, matching, quality
from starloom.plans.arrivals import clean_temperatures, dim_city_demos, dim_temperatures
from starloom.plans.plays import build_artists, build_songs, plays_of
from starloom.queries import shapes
from starloom.queries.registry import query
from starloom.sources.files import port_codes

PC = f"WITH {shapes.PLAYS_CATALOG_SQL} "
_OUT = ("sessionId AS session_id, itemInSession AS item_in_session, userId AS user_id, ts, song, "
        "song_id, artist_id")


def _shown(df):
    return df.select(
        F.col("sessionId").alias("session_id"), F.col("itemInSession").alias("item_in_session"),
        F.col("userId").alias("user_id"), "ts", "song", "song_id", "artist_id",
    )


FIRST_SQL = """first_match AS (
  SELECT title, artist_name, cast(duration AS decimal(18,5)) AS d, min(song_id) AS song_id,
         arg_min(artist_id, (song_id, artist_id)) AS artist_id
  FROM catalog GROUP BY ALL),
matched AS (
  SELECT plays.*, song_id, artist_id FROM plays LEFT JOIN first_match
  ON song = title AND artist = artist_name AND cast(length AS decimal(18,5)) = d)"""


@query("join_catalog_first_match", f"{PC}, {FIRST_SQL} SELECT {_OUT} FROM matched")
def join_catalog_first_match(t):
    plays = plays_of(shapes.play_log(t))
    return _shown(matching.match_plays(plays, shapes.catalog(t), pick="first"))


@query(
    "join_catalog_first_match_two_keys",
    f"""{PC}, firsts AS (
      SELECT title, artist_name, min(song_id) AS song_id,
             arg_min(artist_id, (song_id, artist_id)) AS artist_id FROM catalog GROUP BY ALL)
    SELECT {_OUT} FROM plays LEFT JOIN firsts ON song = title AND artist = artist_name""",
)
def join_catalog_first_match_two_keys(t):
    """Where several songs match, the first of them is taken."""
    plays = plays_of(shapes.play_log(t))
    return _shown(matching.match_plays(
        plays, shapes.catalog(t), pick="first", duration_scale=None
    ))


@query(
    "join_catalog_inner",
    f"{PC} SELECT {_OUT} FROM plays JOIN catalog ON song = title AND artist = artist_name",
)
def join_catalog_inner(t):
    plays = plays_of(shapes.play_log(t))
    return _shown(matching.match_plays(
        plays, shapes.catalog(t), duration_scale=None, how="inner"
    ))


DIMS_SQL = """songs AS (SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog),
artists AS (SELECT DISTINCT artist_id, artist_name,
  CASE WHEN trim(artist_location) = '' THEN NULL ELSE artist_location END AS artist_location,
  artist_latitude, artist_longitude FROM catalog)"""
_TWO = _OUT.replace("artist_id", "artists.artist_id")


@query(
    "join_catalog_two_step",
    f"{PC}, {DIMS_SQL} SELECT {_TWO} FROM plays JOIN songs ON song = title "
    "JOIN artists ON artist = artist_name",
)
def join_catalog_two_step(t):
    records = shapes.catalog(t)
    songs, artists = build_songs(records), build_artists(records, "distinct_required")
    return _shown(matching.match_plays_two_step(plays_of(shapes.play_log(t)), songs, artists))


@query(
    "join_catalog_two_step_strict",
    f"{PC}, {DIMS_SQL} SELECT {_TWO} FROM plays JOIN songs ON song = title "
    "JOIN artists ON artist = artist_name AND songs.artist_id = artists.artist_id",
)
def join_catalog_two_step_strict(t):
    """The song's artist must be the matched one."""
    records = shapes.catalog(t)
    songs, artists = build_songs(records), build_artists(records, "distinct_required")
    plays = plays_of(shapes.play_log(t))
    return _shown(matching.match_plays_two_step(plays, songs, artists, strict=True))


@query(
    "join_catalog_left",
    f"{PC} SELECT {_OUT} FROM plays LEFT JOIN catalog ON song = title AND artist = artist_name "
    "AND trunc(length)::bigint = trunc(duration)::bigint",
)
def join_catalog_left(t):
    """Durations are compared in whole seconds, cut off, so several songs may match."""
    plays = plays_of(shapes.play_log(t))
    return _shown(matching.match_plays(
        plays, shapes.catalog(t), duration_scale=0, duration_mode="truncate"
    ))


@query(
    "join_fact_dim",
    "SELECT p_type, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem "
    "JOIN part ON l_partkey = p_partkey GROUP BY p_type",
)
def join_fact_dim(t):
    """The fact is summed per key first; the join moves one row per part."""
    sums = t("lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("q"), F.count("*").alias("n")
    )
    part = t("part").select("p_partkey", "p_type")
    joined = sums.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_type").agg(F.sum("q").alias("quantity"), F.sum("n").alias("n"))


@query(
    "join_fact_two_dims",
    "SELECT l_orderkey, l_linenumber, l_quantity, p_name, s_name FROM lineitem "
    "JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey",
)
def join_fact_two_dims(t):
    fact = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    part, supplier = t("part"), t("supplier")
    joined = fact.join(part, fact.l_partkey == part.p_partkey).join(
        supplier, fact.l_suppkey == supplier.s_suppkey
    )
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "p_name", "s_name")


@query(
    "join_snowflake_chain",
    "SELECT r_name, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "GROUP BY r_name, n_name",
)
def join_snowflake_chain(t):
    """Nation and region are reached through the supplier."""
    supplier, nation, region = t("supplier"), t("nation"), t("region")
    counts = t("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("_n"))
    chain = (
        counts.join(supplier, counts.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    return chain.groupBy("r_name", "n_name").agg(F.sum("_n").alias("n"))


@query(
    "join_self_argmax",
    """WITH c AS (SELECT c_nationkey, month(o_orderdate)::int AS month, o_orderdate, o_orderkey
                  FROM orders JOIN customer ON o_custkey = c_custkey),
       m AS (SELECT c_nationkey, month, max(o_orderdate) AS d FROM c GROUP BY ALL)
    SELECT c.c_nationkey, c.month, o_orderdate, o_orderkey FROM c JOIN m
    ON c.c_nationkey = m.c_nationkey AND c.month = m.month AND o_orderdate = d""",
)
def join_self_argmax(t):
    orders, customer = t("orders"), t("customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "c_nationkey", F.month("o_orderdate").alias("month"), "o_orderdate", "o_orderkey"
    )
    return aggregates.rows_at_max(rows, ["c_nationkey", "month"], "o_orderdate")


TEMP_SQL = f"""{shapes.PORTS_SQL}, {shapes.TEMPERATURES_SQL}, {shapes.DEMOGRAPHICS_SQL},
readings AS (
  SELECT cast(dt AS date) AS d, cast(AverageTemperature AS double) AS avg_temperature, City AS city,
         Country AS country, Latitude AS latitude, Longitude AS longitude
  FROM temperatures WHERE Country = 'United States' AND AverageTemperature IS NOT NULL),
newest AS (SELECT city, month(d) AS m, max(d) AS d FROM readings GROUP BY ALL),
city_port AS (SELECT city, min(code) AS port_code FROM ports WHERE is_valid GROUP BY city),
dim_temp AS (
  SELECT readings.*, port_code FROM readings JOIN newest
    ON readings.city = newest.city AND month(readings.d) = m AND readings.d = newest.d
  JOIN city_port ON lower(readings.city) = city_port.city),
state_port AS (SELECT city, state, min(code) AS port_code FROM ports WHERE is_valid
               GROUP BY city, state),
dim_demo AS (
  SELECT d.City AS city, d.State AS state, cast(d."Median Age" AS double) AS median_age,
         cast(d."Male Population" AS bigint) AS male_population,
         cast(d."Female Population" AS bigint) AS female_population,
         cast(d."Total Population" AS bigint) AS total_population,
         cast(d."Number of Veterans" AS bigint) AS veteran_population,
         cast(d."Foreign-born" AS bigint) AS foreign_born_population,
         cast(d."Average Household Size" AS double) AS avg_household_size,
         d."State Code" AS state_abbr, d.Race AS race, cast(d.Count AS bigint) AS race_count,
         port_code
  FROM demographics d JOIN state_port p
    ON lower(d.City) = p.city AND lower(d."State Code") = p.state
  WHERE d."Average Household Size" IS NOT NULL)"""


def temperature_dim(t):
    return dim_temperatures(
        clean_temperatures(shapes.temperatures(t)), port_codes(shapes.port_lines(t))
    )


def demographics_dim(t):
    return dim_city_demos(shapes.demographics(t), port_codes(shapes.port_lines(t)))


@query(
    "join_on_expression",
    f"""WITH {TEMP_SQL}, {shapes.ARRIVALS_SQL}
    SELECT i94port AS port_code, cast(i94mon AS int) AS month, arrdate, avg_temperature
    FROM arrivals JOIN dim_temp ON i94port = port_code AND cast(i94mon AS int) = month(d)""",
)
def join_on_expression(t):
    """The month of the reading is computed before the join, which stays an equi-join."""
    rows = shapes.arrivals(t).select(
        F.col("i94port").alias("port_code"), F.col("i94mon").cast("int").alias("month"), "arrdate"
    )
    readings = temperature_dim(t).select(
        "port_code", F.month("date").alias("month"), "avg_temperature"
    )
    return rows.join(readings, ["port_code", "month"])


@query(
    "join_three_way_fact",
    f"""WITH {TEMP_SQL}, {shapes.ARRIVALS_SQL}
    SELECT DISTINCT i94port AS port_code, cast(i94mon AS int) AS month, arrdate, avg_temperature,
           median_age, total_population
    FROM arrivals JOIN dim_temp ON i94port = dim_temp.port_code AND cast(i94mon AS int) = month(d)
    JOIN dim_demo ON i94port = dim_demo.port_code""",
)
def join_three_way_fact(t):
    """Race rows are reduced to one row per port and its values before the join."""
    city = demographics_dim(t).select("port_code", "median_age", "total_population").distinct()
    return join_on_expression(t).join(city, "port_code").distinct()


@query(
    "join_code_lookup",
    f"""WITH {TEMP_SQL}
    SELECT t.City AS city, t.dt, p.port_code FROM temperatures t
    LEFT JOIN city_port p ON lower(t.City) = p.city""",
)
def join_code_lookup(t):
    rows = shapes.temperatures(t).select(F.col("City").alias("city"), "dt")
    return lookups.add_port_code(rows, port_codes(shapes.port_lines(t)), "city")


SEMI = "FROM orders WHERE {n} EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey " \
       "AND c_mktsegment = 'BUILDING')"


@query("join_semi_membership", "SELECT o_orderkey, o_custkey " + SEMI.format(n=""))
def join_semi_membership(t):
    members = t("customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    orders = t("orders").select("o_orderkey", "o_custkey")
    return orders.join(members, orders.o_custkey == members.c_custkey, "left_semi")


@query("join_anti_orphans", "SELECT o_orderkey, o_custkey " + SEMI.format(n="NOT"))
def join_anti_orphans(t):
    members = t("customer").where("c_mktsegment = 'BUILDING'")
    orders = t("orders").select("o_orderkey", "o_custkey")
    return quality.orphans(orders, "o_custkey", members, "c_custkey")
