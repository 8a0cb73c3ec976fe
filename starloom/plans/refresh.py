"""The scheduled refresh: stage new files, check and append the fact, refresh dimensions.

The cost of a run follows its batch: the fact and the times are compared only in the months that
the batch touches, users are merged once per run and only in the hash buckets of the batch's
users, and checks look at rows before they are stored. When the catalog has changed, the months
with a play whose matches changed are built again (`plans.matches`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.contracts import PLAY_LOG, STAGED_EVENTS, TIMES, TableContract
from starloom.functions.timeparts import calendar_parts, start_time
from starloom.operators.merge import last_wins
from starloom.operators.quality import assert_quality, contract_report, foreign_key_in_buckets, row_checks
from starloom.operators.snapshots import merge_snapshot, read_snapshot, replace_snapshot
from starloom.operators.tables import missing_in, publish, recover, stage_in, write_table
from starloom.plans.matches import BATCH, MONTH, append_keys, journal_of, play_identity, settle, with_play_id
from starloom.plans.plays import HOURLY, PLAY_COLUMNS, Preset, build_song_dims, layouts, plays_of
from starloom.session import scratch_path
from starloom.sources.files import arrival_order
from starloom.sources.staging import enforce_max_error, load_lines, loaded, rejects, stage_lines
from starloom.streaming.incremental import run_incremental

# Hash buckets of the users and of the keys of songs and artists.
BUCKETS = 16
KEYS = {"songs": "song_id", "artists": "artist_id"}
STAR = ("songplays", "users", "songs", "artists", "times")
USER_ORDER = ["last_ts", "last_item"]
# What a kept play must have.
PLAYS = TableContract(
    "plays", "", not_null=("ts", "userId", "level", "sessionId"),
    checks={"user_is_a_number": "try_cast(userId AS int) IS NOT NULL"},
    max_length={"level": 4, "location": 128, "userAgent": 256},
)


def users_of(plays: DataFrame) -> DataFrame:
    """The newest row of each user of some plays, with the time of that play."""
    users = plays.select(
        F.col("userId").try_cast("int").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        F.col("ts").alias("last_ts"),
        F.col("itemInSession").alias("last_item"),
    ).where(F.col("user_id").isNotNull())
    return last_wins(users, ["user_id"], USER_ORDER, keep_order=True)


def append_times(plays: DataFrame, path: str, preset: Preset) -> None:
    """Add the start times of a batch, which has their months, that the time dimension lacks."""
    times = plays.select(start_time(F.col("ts"), preset.precision).alias("start_time"), *MONTH)
    times = missing_in(times.where(F.col("start_time").isNotNull()), path, ["start_time", *MONTH], MONTH, plays)
    if times is not None:
        rows = times.select("start_time", *calendar_parts(F.col("start_time"), preset.weekday))
        write_table(rows, path, TIMES.partition_by, mode="append", gather=False)


def arrivals_of(journal: DataFrame) -> DataFrame:
    """What the end of a run needs of a batch: the newest row of each of its users and, with no
    user, its months."""
    return users_of(journal).unionByName(journal.select(*MONTH).distinct(), allowMissingColumns=True)


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The tables that a run has left: users from their newest version, the others from their folders."""
    return {
        name: read_snapshot(spark, path) if name == "users" else spark.read.parquet(path)
        for name, path in paths.items()
    }


def run_hourly(
    spark: SparkSession, log_path: str, catalog: DataFrame, out: str, preset: Preset = HOURLY,
    staged: bool = True, max_error: int = 0, files_per_batch: int | None = None,
    dims: dict[str, DataFrame] | None = None, keys: dict[str, str] | None = None, **options,
) -> dict[str, str]:
    """One run over the log files that have not been seen.

    The lines are staged with the options of `sources.staging.stage_lines`, and a batch with more
    than `max_error` bad lines stops the run before anything of it is stored; what is wrong with
    them is in `rejects`. With `staged=False` the files are read plainly. The dimensions of the
    catalog are rebuilt, checked and swapped (or given as `dims`, if they are kept elsewhere, with
    `keys` naming tables in buckets of song_id and artist_id to check the fact against). Plays
    without a song are legal; a missing key is not. Plays of one session, second and item that differ go to `conflicts`. The fact is as
    if all plays had been matched with this run's catalog. The key must be the same in every run
    and one per row, and unmatched plays must be kept.
    """
    if preset.key != "row" or preset.how != "left":
        raise ValueError("an incremental fact needs a key that is the same in every run, one per "
                         "row, and its unmatched plays")
    contracts = layouts(preset)
    paths = {t: f"{out}/{t}" for t in (*STAR, "plays", "play_keys", "matches", "conflicts", "rejects")}
    mapped = {"mapping": "exact", **options}
    if dims is None:
        dims = {}
        for name, table in build_song_dims(catalog, preset).items():
            recover(spark, paths[name])
            fresh = stage_in(table, paths[name])
            assert_quality(contract_report(fresh, contracts[name]))
            publish(spark, paths[name])
            dims[name] = spark.read.schema(fresh.schema).parquet(paths[name])
            key = contracts["songplays"].foreign_keys[KEYS[name]][1]
            replace_snapshot(dims[name].select(key).distinct(), f"{out}/{name}_keys", [key], BUCKETS)
        keys = {KEYS[name]: f"{out}/{name}_keys" for name in dims}

    def stage(lines: DataFrame, number: int) -> DataFrame:
        """Rows of a batch; what could not be loaded goes to the rejects, also if the run stops."""
        if max_error == 0:
            rows = stage_lines(lines.select("value"), STAGED_EVENTS, **mapped)
            return enforce_max_error(rows).select("page", *PLAY_COLUMNS)
        path = scratch_path(spark, "load")
        try:
            load_lines(lines.select("value", arrival_order()), STAGED_EVENTS, path, max_error, **mapped)
        finally:
            rejects(spark, path).write.mode("overwrite").parquet(f"{paths['rejects']}/batch={number}")
        return loaded(spark, path, STAGED_EVENTS).select("page", *PLAY_COLUMNS)

    def before(batch: DataFrame) -> None:
        assert_quality(row_checks(batch, PLAYS))
        append_times(batch, paths["times"], preset)
        append_keys(batch, paths["play_keys"], preset)

    def check(fact: DataFrame) -> None:
        """Rows by themselves, and their keys against the buckets that hold those keys."""
        report = row_checks(fact, contracts["songplays"])
        for column, path in {**(keys or {}), "user_id": paths["users"]}.items():
            parent = contracts["songplays"].foreign_keys[column][1]
            report = report.unionByName(foreign_key_in_buckets(fact, column, path, parent))
        assert_quality(report)

    def refresh(left: DataFrame | None) -> None:
        arrived: dict[int, list[tuple[int, int]]] = {}
        if left is not None:
            users = left.where(F.col("user_id").isNotNull()).drop(BATCH, *MONTH)
            merge_snapshot(users, paths["users"], ["user_id"], USER_ORDER, buckets=BUCKETS, keep_order=True)
            # At most one row per batch and month comes to the driver.
            for r in left.where(F.col("user_id").isNull()).select(BATCH, *MONTH).collect():
                arrived.setdefault(r[BATCH], []).append((r.year, r.month))
        settle(spark, paths, arrived, catalog, dims, preset, check)

    run_incremental(
        spark, log_path, PLAY_LOG, paths["plays"], f"{out}/_checkpoint",
        key=["play_id", "year", "month"], transform=lambda rows: journal_of(plays_of(rows), preset),
        partition_by=MONTH, collect=arrivals_of, before=before, stage=stage if staged else None,
        refresh=refresh, always=True, fmt="text" if staged else "json", files_per_batch=files_per_batch,
        conflicts=paths["conflicts"], laid_out=True, late=lambda rows: with_play_id(rows, preset),
        hashed=play_identity(), numbered=BATCH,
    )
    return {t: paths[t] for t in STAR}
