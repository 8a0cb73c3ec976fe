"""The play star: one build, with the step semantics chosen by a preset."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.contracts import (
    ARTISTS, PLAY_LOG, SONG_CATALOG, SONGPLAYS, SONGPLAYS_BY_ROW, SONGPLAYS_BY_SESSION_TIME, SONGS,
    STAGED_EVENTS, STAGED_SONGS, TIMES, USERS, TableContract,
)
from starloom.functions.text import blank_to_null
from starloom.functions.timeparts import calendar_parts, start_time
from starloom.operators import merge
from starloom.operators.cleaning import equals, require
from starloom.operators.keys import dense_key, hashed_key, monotonic_key, row_key
from starloom.operators.layout import repartition_by_columns
from starloom.operators.matching import catalog_of, match_plays, match_plays_two_step
from starloom.operators.quality import assert_quality, contract_report, has_rows
from starloom.operators.tables import publish, stage_in
from starloom.session import kept, written
from starloom.sources.files import ARRIVAL, scan_json
from starloom.sources.staging import stage_json

# Fixed value: the page of a play.
PLAY_PAGE = "NextSong"


@dataclass(frozen=True)
class Preset:
    """How each step of the build behaves.

    precision: 'ms' or 's'. match: 'keys' or 'two_step'. catalog: match the raw 'records' or
    the merged 'dims'. duration_scale: None leaves the duration out of the match. dedup: distinct
    fact rows after the time is cut. key: 'dense', 'monotonic', 'md5' (of session and time, which
    several rows may share) or 'row' (of session, time, item and song, one per row). users: 'last_wins', 'distinct' or 'distinct_complete'. songs:
    'fill_zero', 'distinct' or 'distinct_required'. artists: 'coalesce', 'distinct' or
    'distinct_required'.
    """

    precision: str = "s"
    match: str = "keys"
    catalog: str = "records"
    duration_scale: int | None = 5
    duration_mode: str = "round"
    how: str = "left"
    pick: str = "all"
    strict: bool = False
    dedup: bool = False
    key: str = "dense"
    key_start: int = 0
    users: str = "last_wins"
    songs: str = "distinct"
    artists: str = "distinct"
    weekday: str = "sun0"


UPSERT = Preset(
    precision="ms", catalog="dims", duration_scale=5, how="left", pick="first", key="dense", key_start=1,
    users="last_wins", songs="fill_zero", artists="coalesce", weekday="mon0",
)
WAREHOUSE = Preset(
    duration_scale=None, how="inner", dedup=True, key="dense", users="distinct",
)
LAKE = Preset(
    match="two_step", how="inner", dedup=True, key="monotonic", users="distinct_complete",
    songs="distinct_required", artists="distinct_required",
)
SCHEDULED = Preset(
    duration_scale=0, duration_mode="truncate", how="left", key="md5", users="distinct",
)
# The scheduled build with a key that an incremental fact can rely on.
HOURLY = replace(SCHEDULED, key="row", users="last_wins")
DEFAULT = replace(UPSERT, precision="s", dedup=True, key="row", weekday="sun0")

CATALOG_ORDER = ARRIVAL
# What the tables of the star need of a play.
PLAY_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "sessionId", "song", "ts", "userAgent", "userId",
]


def plays_of(events: DataFrame) -> DataFrame:
    """Play events only."""
    return equals(events, "page", PLAY_PAGE)


def build_users(plays: DataFrame, mode: str = "last_wins") -> DataFrame:
    users = plays.select(
        F.col("userId").try_cast("int").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
        "itemInSession",
    )
    if mode == "last_wins":
        known = users.where(F.col("user_id").isNotNull())
        return merge.last_wins(known, ["user_id"], ["ts", "itemInSession"])
    rows = users.select(*USERS.column_names).distinct()
    return rows.dropna("any") if mode == "distinct_complete" else rows


def build_times(
    plays: DataFrame, precision: str = "s", weekday: str = "sun0", gathered: bool = False
) -> DataFrame:
    """One row per distinct play time; calendar parts are computed after the distinct. If they are
    `gathered`, the times of a month come together in the one shuffle that makes them distinct."""
    times = plays.select(start_time(F.col("ts"), precision).alias("start_time"))
    if gathered:
        times = repartition_by_columns(partitioned_by_month(times), ["year", "month"])
    times = times.distinct().where(F.col("start_time").isNotNull())
    return times.select("start_time", *calendar_parts(F.col("start_time"), weekday))


def build_songs(records: DataFrame, mode: str = "distinct") -> DataFrame:
    """Songs of the catalog. `fill_zero` needs an arrival order in column `_order`, if any."""
    columns = SONGS.column_names
    if mode == "fill_zero":
        order = [CATALOG_ORDER] if CATALOG_ORDER in records.columns else []
        return merge.fill_zero(records.select(*columns, *order), ["song_id"], order).select(*columns)
    songs = records.select(*columns)
    if mode == "distinct":
        return songs.distinct()
    return require(songs.fillna(0, ["year"]).distinct(), ["song_id", "title", "artist_id"])


def build_artists(records: DataFrame, mode: str = "distinct") -> DataFrame:
    columns = ARTISTS.column_names
    if mode == "coalesce":
        order = [CATALOG_ORDER] if CATALOG_ORDER in records.columns else []
        rows = records.select(*columns, *order)
        return merge.coalesce_newest(rows, ["artist_id"], order, keep=["artist_name"])
    artists = records.select(*columns)
    if mode == "distinct":
        return artists.distinct()
    artists = artists.withColumn("artist_location", blank_to_null(F.col("artist_location")))
    return require(artists.distinct(), ["artist_id", "artist_name"])


def match(
    plays: DataFrame, records: DataFrame, dims: dict[str, DataFrame], preset: Preset
) -> DataFrame:
    if preset.match == "two_step":
        return match_plays_two_step(plays, dims["songs"], dims["artists"], preset.strict)
    catalog = records if preset.catalog == "records" else catalog_of(dims["songs"], dims["artists"])
    return match_plays(
        plays, catalog, duration_scale=preset.duration_scale,
        duration_mode=preset.duration_mode, how=preset.how, pick=preset.pick,
    )


def build_songplays(
    plays: DataFrame, records: DataFrame, dims: dict[str, DataFrame], preset: Preset, keyed: bool = True
) -> DataFrame:
    """Fact rows: plays with their song, keyed as the preset says. Digests are left to
    `with_digest` if not `keyed`: what follows from a row need not be moved with it."""
    matched = match(plays, records, dims, preset)
    fact: list[Column] = [
        start_time(F.col("ts"), preset.precision).alias("start_time"),
        F.col("userId").try_cast("int").alias("user_id"),
        F.col("level"),
        F.col("song_id"),
        F.col("artist_id"),
        F.col("sessionId").alias("session_id"),
        F.col("location"),
        F.col("userAgent").alias("user_agent"),
    ]
    columns = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
               "user_agent"]
    by_row = preset.key == "row"
    rows = matched.select(*fact, *[F.col("itemInSession").alias("_item")] * by_row)
    if preset.dedup:
        rows = rows.distinct()
    if preset.key == "dense":
        order = ["start_time", "session_id", *[c for c in columns
                                               if c not in ("start_time", "session_id")]]
        rows = dense_key(rows, order, "songplay_id", preset.key_start, unique=preset.dedup)
    elif preset.key == "monotonic":
        rows = monotonic_key(rows, "songplay_id")
    else:
        return with_digest(rows, preset) if keyed else rows
    return rows.select("songplay_id", *columns)


def with_digest(rows: DataFrame, preset: Preset) -> DataFrame:
    """Rows of the fact with their digest as key, first; item numbers go."""
    if preset.key == "row":
        keyed = row_key(rows, ["session_id", "start_time", "_item", "song_id"], "songplay_id")
    else:
        keyed = hashed_key(rows, ["session_id", "start_time"], "songplay_id")
    return keyed.select("songplay_id", *[c for c in rows.columns if c != "_item"])


def build_song_dims(records: DataFrame, preset: Preset = DEFAULT) -> dict[str, DataFrame]:
    return {
        "songs": build_songs(records, preset.songs),
        "artists": build_artists(records, preset.artists),
    }


def build_play_star(
    events: DataFrame, records: DataFrame, preset: Preset = DEFAULT
) -> dict[str, DataFrame]:
    """All five tables of the star from raw events and catalog records."""
    plays = plays_of(events)
    dims = build_song_dims(records, preset)
    return {
        **dims,
        "users": build_users(plays, preset.users),
        "times": build_times(plays, preset.precision, preset.weekday),
        "songplays": build_songplays(plays, records, dims, preset),
    }


def partitioned_by_month(fact: DataFrame) -> DataFrame:
    """Add the partition columns of the fact and time tables."""
    return fact.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


PRESETS = {
    "default": DEFAULT, "upsert": UPSERT, "warehouse": WAREHOUSE, "lake": LAKE,
    "scheduled": SCHEDULED,
}
_FACTS = {"row": SONGPLAYS_BY_ROW, "md5": SONGPLAYS_BY_SESSION_TIME}


def layouts(preset: Preset) -> dict[str, TableContract]:
    """The contracts of the five tables under a preset.

    Merged dimensions have one row per key; where rows are only made distinct, a key may have
    several and is not declared. The fact's key has the type and the uniqueness of its kind.
    """
    def dim(contract: TableContract, merged: bool) -> TableContract:
        return contract if merged else replace(contract, primary_key=())

    return {
        "songs": dim(SONGS, preset.songs == "fill_zero"),
        "artists": dim(ARTISTS, preset.artists == "coalesce"),
        "users": dim(USERS, preset.users == "last_wins"),
        "times": TIMES,
        "songplays": _FACTS.get(preset.key, SONGPLAYS),
    }


def star_report(tables: dict[str, DataFrame], preset: Preset) -> DataFrame:
    """All checks of the contracts of the star, as (table_name, check_name, violations)."""
    report = None
    for name, contract in layouts(preset).items():
        part = contract_report(tables[name], contract, tables).withColumn("table_name", F.lit(name))
        report = part if report is None else report.unionByName(part)
    return report.select("table_name", "check_name", "violations")


def report_names(preset: Preset) -> list[tuple[str, str]]:
    """(table, check) of every row of `star_report`."""
    out = []
    for name, c in layouts(preset).items():
        checks = [f"not_null:{x}" for x in c.not_null] + [f"check:{x}" for x in c.checks]
        checks += [f"max_length:{x}" for x in c.max_length]
        checks += [f"primary_key:{','.join(c.primary_key)}"] * bool(c.primary_key)
        out += [(name, x) for x in [*checks, *[f"foreign_key:{x}" for x in c.foreign_keys]]]
    return out


def read_inputs(
    spark: SparkSession, log_path: str, song_path: str, staged: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Events and catalog records from JSON folders, plainly or through the staging load.

    The records carry their order of arrival, which the merges of songs and artists follow.
    """
    if staged:
        return (
            stage_json(spark, log_path, STAGED_EVENTS, mapping="exact"),
            stage_json(spark, song_path, STAGED_SONGS, mapping="exact", arrival=True),
        )
    return (
        scan_json(spark, log_path, PLAY_LOG),
        scan_json(spark, song_path, SONG_CATALOG, arrival=True),
    )


@contextmanager
def stored_inputs(
    spark: SparkSession, log_path: str, song_path: str, staged: bool = False
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Plays and records, parsed once and written to the shared folder, for one star or several."""
    events, records = read_inputs(spark, log_path, song_path, staged)
    plays = plays_of(events).select(*PLAY_COLUMNS)
    with kept(plays, "plays") as plays, kept(records, "records") as records:
        yield plays, records


def run_play_star(
    spark: SparkSession, log_path: str, song_path: str, out: str, preset: Preset = DEFAULT,
    staged: bool = False, inputs: tuple[DataFrame, DataFrame] | None = None,
    reports: list[DataFrame] | None = None,
) -> dict[str, str]:
    """JSON folders to the five written tables.

    Plays and records are parsed once, written to the shared folder and read from there; the
    fact is matched with the written dimensions. The tables are written beside the old ones,
    checked against their contracts and only then published. Songs are partitioned by year and
    sorted by artist, times and the fact by month. `inputs` are those of `stored_inputs`, if
    several stars are built from one log. `reports` gets the `star_report` that was passed, stored.
    """
    contracts = layouts(preset)
    paths = {name: f"{out}/{name}" for name in contracts}
    tables: dict[str, DataFrame] = {}

    def save(name: str, table: DataFrame, **layout) -> None:
        sort = contracts[name].sort_by if name == "songs" else ()
        tables[name] = stage_in(table, paths[name], contracts[name].partition_by, sort, **layout)

    with nullcontext(inputs) if inputs else stored_inputs(spark, log_path, song_path, staged) as (plays, records):
        for name, table in build_song_dims(records, preset).items():
            save(name, table)
        save("users", build_users(plays, preset.users))
        # A month has 2.7 million seconds at most, however many plays.
        by_month = preset.precision == "s"
        save("times", build_times(plays, preset.precision, preset.weekday, by_month), gather=not by_month)
        dims = {name: tables[name] for name in ("songs", "artists")}
        fact = partitioned_by_month(build_songplays(plays, records, dims, preset, keyed=False))
        # Dense numbers of distinct rows follow the time: each task has few months already.
        late = (lambda rows: with_digest(rows, preset)) if preset.key in _FACTS else None
        save("songplays", fact, gather=not (preset.key == "dense" and preset.dedup), late=late)
    assert_quality(has_rows(tables))
    report = star_report(tables, preset)
    if reports is not None:
        report = written(report, "report")
        reports.append(report)
    assert_quality(report)
    for path in paths.values():
        publish(spark, path)
    return paths
