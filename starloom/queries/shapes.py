"""Inputs of the operators, derived from the test tables.

Column expressions are plain SQL that both engines read alike, so a shape is stated once and
used by the query and by its twin. Nulls, blanks and unmatched keys, which the tables lack, are
derived from the keys of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.queries.registry import Tables


def columns(exprs: dict[str, str]) -> list[str]:
    return [f"{e} AS {name}" for name, e in exprs.items()]


def select_sql(exprs: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(columns(exprs))} FROM {source}"


# --- play log and catalog ---
# Three parts share a title; two of them share the artist, so a match on title and artist finds
# two songs, and one that adds the duration finds one. Every seventh part is played under a
# title that the catalog lacks.

_TITLE = "('Song ' || cast(floor(p_partkey / 3) as bigint))"
_ARTIST = (
    "(case when p_partkey % 3 = 2 then p_brand "
    "else 'Artist ' || (cast(floor(p_partkey / 3) as bigint) % 50) end)"
)
_PLAY = "l_returnflag <> 'R'"

_LOG = {
    "artist": f"case when {_PLAY} then {_ARTIST} end",
    "auth": "'Logged In'",
    "firstName": "c_mktsegment",
    "gender": "case when c_custkey % 2 = 0 then 'F' else 'M' end",
    "itemInSession": "l_linenumber",
    "lastName": "c_name",
    "length": f"case when {_PLAY} then p_retailprice + cast(0.000001 as double) end",
    "level": "case when l_linestatus = 'F' then 'free' else 'paid' end",
    "location": "('NATION_' || c_nationkey)",
    "method": "'PUT'",
    "page": f"case when {_PLAY} then 'NextSong' else 'Home' end",
    "registration": "cast(1500000000000 + c_custkey as double)",
    "sessionId": "l_orderkey",
    "song": f"case when {_PLAY} then (case when l_partkey % 7 = 0 then {_TITLE} || '?' "
            f"else {_TITLE} end) end",
    "status": "200",
    "ts": "{epoch_ms} + (l_partkey % 86400) * 1000 + l_linenumber * 137",
    "userAgent": "('agent ' || (l_suppkey % 10))",
    "userId": "cast(o_custkey as string)",
}

_SPARK_MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)"


def play_log(t: Tables) -> DataFrame:
    joined = _join(t("lineitem"), t("part"), "l_partkey", "p_partkey")
    ordered = _join(t("orders"), t("customer"), "o_custkey", "c_custkey")
    joined = _join(joined, ordered, "l_orderkey", "o_orderkey")
    exprs = {**_LOG, "ts": _LOG["ts"].format(epoch_ms=_SPARK_MS)}
    return joined.selectExpr(*columns(exprs))


def _join(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    return left.join(right, left[a] == right[b])


LOG_SQL = "log AS (" + select_sql(
    {**_LOG, "ts": _LOG["ts"].format(epoch_ms="epoch_ms(l_shipdate)")},
    "lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey",
) + ")"

PLAYS_SQL = f"{LOG_SQL}, plays AS (SELECT * FROM log WHERE page = 'NextSong')"

_CATALOG = {
    "num_songs": "1",
    "artist_id": f"('AR ' || {_ARTIST})",
    "artist_latitude":
        f"case when p_size % 5 = 0 then null else length({_ARTIST}) * cast(1.25 as double) end",
    "artist_longitude":
        f"case when p_size % 5 = 0 then null else length({_ARTIST}) * cast(-2.5 as double) end",
    "artist_location": f"case when p_size % 5 = 0 then '   ' else 'City of ' || {_ARTIST} end",
    "artist_name": _ARTIST,
    "song_id": "('SO' || p_partkey)",
    "title": _TITLE,
    "duration": "p_retailprice",
    "year": "cast(case when p_size % 3 = 0 then 0 else 1950 + p_size end as int)",
    "_order": "p_partkey",
}


def catalog(t: Tables) -> DataFrame:
    return t("part").selectExpr(*columns(_CATALOG))


CATALOG_SQL = f"catalog AS ({select_sql(_CATALOG, 'part')})"
PLAYS_CATALOG_SQL = f"{PLAYS_SQL}, {CATALOG_SQL}"


# Songs that arrive several times, under other titles and artists; artists likewise.
_ARRIVED = {**_CATALOG, "song_id": "('SO' || (p_partkey % 61))", "artist_id": "('AR' || (p_partkey % 17))"}


def arrived_catalog(t: Tables) -> DataFrame:
    return t("part").selectExpr(*columns(_ARRIVED))


ARRIVED_SQL = f"arrived AS ({select_sql(_ARRIVED, 'part')})"


# --- dirty events: nulls, blanks and empty strings among the event types ---

_DIRTY = {
    "event_id": "event_id",
    "ts": "ts",
    "user_id": "user_id",
    "event_type": "case when event_id % 7 = 0 then null when event_id % 11 = 0 then '  ' "
                  "when event_id % 13 = 0 then '' else event_type end",
    "value": "case when event_id % 5 = 0 then null else value end",
}


def dirty_events(t: Tables) -> DataFrame:
    return t("events").selectExpr(*columns(_DIRTY))


DIRTY_SQL = f"dirty AS ({select_sql(_DIRTY, 'events')})"


# --- arrivals, ports, temperature, demographics ---
# A supplier is a port and its city. Customers arrive through the port numbered by their key;
# an order is one arrival, and also one temperature reading of that city.

_PORT = "cast(floor(o_custkey / 15) as bigint)"
_STATE = (
    "substring('ALAKAZARCACOCTDEFLGAHIIDILINIAKSKYLAMEMDMAMIMNMSMOMTNENVNHNJ', "
    "(s_nationkey * 2 + 1), 2)"
)

_PORT_LABEL = (
    f"(case when s_suppkey % 20 = 13 then 'INVALID: CITY ' || s_suppkey "
    f"when s_suppkey % 20 = 7 then 'CITY ' || s_suppkey || ' ' || {_STATE} "
    f"when s_suppkey % 20 = 9 then 'CITY ' || s_suppkey || ',' || {_STATE} "
    f"else 'CITY ' || s_suppkey || ', ' || {_STATE} end)"
)


def port_lines(t: Tables) -> DataFrame:
    """The port listing as text lines."""
    return t("supplier").selectExpr(
        f"\"   'S\" || s_suppkey || \"'\t=\t'\" || {_PORT_LABEL} || \"    '\" AS value"
    )


PORTS_SQL = f"""ports AS (
  SELECT 'S' || s_suppkey AS code,
         replace({_PORT_LABEL}, 'INVALID: ', '') AS label,
         s_suppkey % 20 <> 13 AS is_valid,
         'city ' || s_suppkey AS city,
         CASE WHEN s_suppkey % 20 = 13 THEN NULL ELSE lower({_STATE}) END AS state
  FROM supplier)"""


def country_lines(t: Tables) -> DataFrame:
    """The country listing as text lines; two countries are marked invalid."""
    return t("nation").selectExpr(
        "'   ' || (100 + n_nationkey) || \" =  '\" || "
        "case when n_nationkey % 12 = 5 then 'INVALID: ' else '' end || "
        "replace(n_name, '_', ' ') || \"'\" AS value"
    )


COUNTRIES_SQL = """countries AS (
  SELECT 100 + n_nationkey AS code, lower(replace(n_name, '_', ' ')) AS country,
         n_nationkey % 12 <> 5 AS is_valid
  FROM nation)"""

_SAS_SPARK = "cast(datediff(cast({d} as date), date'1960-01-01') as double)"
_SAS_DUCK = "cast(date_diff('day', date '1960-01-01', cast({d} as date)) as double)"

_ARRIVALS = {
    "i94yr": "cast(year(o_orderdate) as double)",
    "i94mon": "cast(month(o_orderdate) as double)",
    "i94cit": "cast(100 + c_nationkey as double)",
    "i94port": f"('S' || {_PORT})",
    "arrdate": "{arr}",
    "i94mode": "cast(o_orderkey % 3 + 1 as double)",
    "i94addr": "case when o_orderkey % 23 = 0 then null else "
               "substring('ALAKAZARCACOCTDEFLGAHIIDILINIAKSKYLAMEMDMAMIMNMSMOMT', "
               "cast(c_nationkey * 2 + 1 as int), 2) end",
    "depdate": "case when o_orderkey % 19 = 0 then null else {arr} + 10 end",
    "i94bir": "cast(20 + c_custkey % 60 as double)",
    "i94visa": "cast(o_orderkey % 3 + 1 as double)",
    "biryear": "cast(year(o_orderdate) - (20 + c_custkey % 60) as double)",
    "gender": "case when c_custkey % 29 = 0 then null when c_custkey % 2 = 0 then 'F' "
              "else 'M' end",
}


def _with_sas(template: str) -> dict[str, str]:
    arr = template.format(d="o_orderdate")
    return {k: e.replace("{arr}", arr) for k, e in _ARRIVALS.items()}


def arrivals(t: Tables) -> DataFrame:
    joined = _join(t("orders"), t("customer"), "o_custkey", "c_custkey")
    return joined.selectExpr(*columns(_with_sas(_SAS_SPARK)))


ARRIVALS_SQL = "arrivals AS (" + select_sql(
    _with_sas(_SAS_DUCK), "orders JOIN customer ON o_custkey = c_custkey"
) + ")"

_TEMPERATURES = {
    "dt": "cast(cast(o_orderdate as date) as string)",
    "AverageTemperature": "case when o_orderkey % 31 = 0 then null "
                          "else cast(floor(o_totalprice / 100) as string) end",
    "AverageTemperatureUncertainty": "'0.5'",
    "City": f"('City ' || {_PORT})",
    "Country": "case when o_orderkey % 17 = 0 then 'Canada' else 'United States' end",
    "Latitude": "(cast(o_orderkey % 90 as string) || 'N')",
    "Longitude": "(cast(o_orderkey % 180 as string) || 'W')",
}


def temperatures(t: Tables) -> DataFrame:
    return t("orders").selectExpr(*columns(_TEMPERATURES))


TEMPERATURES_SQL = f"temperatures AS ({select_sql(_TEMPERATURES, 'orders')})"

# One row per (city, market segment), the segments standing for the groups of the source.
_DEMOGRAPHICS = {
    "City": "('City ' || s_suppkey)",
    "State": "('State ' || s_nationkey)",
    "`Median Age`": "cast(20 + s_suppkey % 40 as string)",
    "`Male Population`": "cast(1000 + s_suppkey * 3 as string)",
    "`Female Population`": "cast(1100 + s_suppkey * 3 as string)",
    "`Total Population`": "cast(2100 + s_suppkey * 6 as string)",
    "`Number of Veterans`": "cast(10 + s_suppkey as string)",
    "`Foreign-born`": "cast(30 + s_suppkey as string)",
    "`Average Household Size`": "case when s_suppkey % 41 = 5 then null else '2.5' end",
    "`State Code`": _STATE,
    "Race": "segment",
    "Count": "cast(n as string)",
}


def demographics(t: Tables) -> DataFrame:
    people = t("customer").selectExpr("cast(floor(c_custkey / 15) as bigint) AS port",
                                      "c_mktsegment AS segment")
    per_city = people.groupBy("port", "segment").count().withColumnRenamed("count", "n")
    return _join(t("supplier"), per_city, "s_suppkey", "port").selectExpr(*columns(_DEMOGRAPHICS))


DEMOGRAPHICS_SQL = (
    "per_city AS (SELECT cast(floor(c_custkey / 15) as bigint) AS port, c_mktsegment AS segment, "
    "count(*) AS n FROM customer GROUP BY ALL), demographics AS ("
    + select_sql({k.replace("`", '"'): e for k, e in _DEMOGRAPHICS.items()},
                 "supplier JOIN per_city ON s_suppkey = port") + ")"
)
