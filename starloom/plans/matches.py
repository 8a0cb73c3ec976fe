"""Matches that come later: plays are matched again when the catalog says something new of them.

Plays are kept as they came, apart from what they match. A play is known by its session, second
and item, whatever song it is found to be. Beside them are two small tables: which match keys
occur in which month, and what the catalog had for each match key when the fact was last built.
When the catalog changes, the keys whose matches differ name the months to build again; all other
months of the fact stay as they are, file by file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.functions.numbers import fit_decimal
from starloom.functions.timeparts import start_time
from starloom.operators.keys import row_key
from starloom.operators.matching import catalog_of
from starloom.operators.snapshots import read_snapshot, replace_snapshot
from starloom.operators.tables import append_fact, beside, exists, missing_in, move_in, write_table
from starloom.plans.plays import PLAY_COLUMNS, Preset, build_songplays, partitioned_by_month, with_digest

MONTH = ["year", "month"]
# The batch that brought a play.
BATCH = "_batch"


def journal_of(plays: DataFrame, preset: Preset) -> DataFrame:
    """Plays with their month, as they are kept but for what `with_play_id` adds."""
    rows = plays.select(*PLAY_COLUMNS, start_time(F.col("ts"), preset.precision).alias("start_time"))
    return partitioned_by_month(rows).drop("start_time")


def with_play_id(journal: DataFrame, preset: Preset) -> DataFrame:
    """The journal with `play_id`, first, which does not depend on a match."""
    rows = journal.withColumn("start_time", start_time(F.col("ts"), preset.precision))
    rows = row_key(rows, ["sessionId", "start_time", "itemInSession"], "play_id")
    others = [c for c in journal.columns if c not in MONTH]
    return rows.select("play_id", *others, *MONTH)


def play_identity() -> list[str | Column]:
    """What a `play_id` is made of, as it is stored."""
    return ["sessionId", F.floor(F.col("ts") / F.lit(1000)), "itemInSession"]


def _keys(preset: Preset, title: Column, artist: Column, length: Column) -> list[Column]:
    """Hashes of all that a play and a catalog row must agree in; NULL if a part is."""
    if preset.match == "two_step":
        return [F.when(title.isNotNull(), F.xxhash64(F.lit("title"), title)),
                F.when(artist.isNotNull(), F.xxhash64(F.lit("artist"), artist))]
    parts = [title, artist]
    if preset.duration_scale is not None:
        parts.append(fit_decimal(length, preset.duration_scale, preset.duration_mode))
    known = reduce(Column.__and__, [p.isNotNull() for p in parts])
    return [F.when(known, F.xxhash64(*parts))]


def _by_key(rows: DataFrame, keys: list[Column], *others: str | Column) -> DataFrame:
    """`others` once for each of the keys, as `match_key`, that is not NULL."""
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return rows.select(key.alias("match_key"), *others).where("match_key IS NOT NULL")


def keys_of_plays(journal: DataFrame, preset: Preset) -> DataFrame:
    """(match_key, year, month): the keys that occur in a month, as often as they do."""
    return _by_key(journal, _keys(preset, F.col("song"), F.col("artist"), F.col("length")), *MONTH)


def matches_of(records: DataFrame, dims: dict[str, DataFrame], preset: Preset) -> DataFrame:
    """(match_key, song_id, artist_id): what the catalog has for each key, each once."""
    if preset.match == "two_step":
        none = F.lit(None).cast("string")
        songs = _by_key(dims["songs"], _keys(preset, F.col("title"), none, none), "song_id", "artist_id")
        artists = _by_key(dims["artists"], _keys(preset, none, F.col("artist_name"), none),
                          none.alias("song_id"), "artist_id")
        return songs.unionByName(artists).distinct()
    catalog = records if preset.catalog == "records" else catalog_of(dims["songs"], dims["artists"])
    keys = _keys(preset, F.col("title"), F.col("artist_name"), F.col("duration"))
    return _by_key(catalog, keys, "song_id", "artist_id").distinct()


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys for which the one has a match that the other lacks: both sides in one aggregate."""
    both = new.withColumn("_n", F.lit(1)).unionByName(old.select(*new.columns).withColumn("_n", F.lit(-1)))
    rows = both.groupBy(*new.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return rows.select("match_key").distinct()


def changed_months(spark: SparkSession, paths: dict[str, str], new: DataFrame) -> list[tuple[int, int]]:
    """Months with a play whose matches changed; all months if nothing is known of the last build.

    At most one row per month comes to the driver.
    """
    if not exists(spark, paths["play_keys"]):
        return []
    keys, old = spark.read.parquet(paths["play_keys"]), read_snapshot(spark, paths["matches"])
    if old is not None:
        keys = keys.join(changed_keys(old, new), "match_key", "left_semi")
    return sorted((r.year, r.month) for r in keys.select(*MONTH).distinct().collect())


def in_months(months: list[tuple[int, int]]) -> Column:
    """A filter on the partition columns alone. The month is worked out once a row, not once a month."""
    return (F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months])


def plays_kept(spark: SparkSession, path: str, months: list[tuple[int, int]], batches: list[int] | None = None) -> DataFrame:
    """The journal of some months, or what some batches added to it there. Statistics of files tell
    which have rows of a batch; journals from before batches were numbered have none."""
    schema = spark.read.parquet(path).schema
    if BATCH not in schema.names:
        schema = StructType([StructField(BATCH, LongType()), *schema])
    rows = spark.read.schema(schema).parquet(path).where(in_months(months))
    return rows if batches is None else rows.where(F.col(BATCH).isin(batches))


def settle(
    spark: SparkSession, paths: dict[str, str], arrived: dict[int, list[tuple[int, int]]], records: DataFrame,
    dims: dict[str, DataFrame], preset: Preset, check,
) -> list[tuple[int, int]]:
    """Bring the fact up to the plays and the catalog; returns the months that were built again.

    `arrived` are the months of each batch of this run, already in the journal. In months whose
    matches changed all plays are matched again and the month is replaced; elsewhere only the new
    plays are matched and appended. Fact rows are written once, beside the fact, checked there and
    moved in. What was matched with is stored last, so that a run that stops is made good by the
    next one. `check` gets fact rows before they are stored and may raise.
    """
    found = matches_of(records, dims, preset)
    months = changed_months(spark, paths, found)

    def built(journal: DataFrame):
        fact = partitioned_by_month(build_songplays(journal, records, dims, preset, keyed=False))
        return beside(fact, paths["songplays"], MONTH, lambda rows: with_digest(rows, preset))

    if months:
        with built(plays_kept(spark, paths["plays"], months)) as (fact, folder):
            check(fact)
            move_in(spark, folder, paths["songplays"], replace=True)
    spans = sorted({m for batch in arrived.values() for m in batch} - set(months))
    if spans:
        with built(plays_kept(spark, paths["plays"], spans, sorted(arrived))) as (fact, folder):
            append_fact(fact, paths["songplays"], ["songplay_id", *MONTH], MONTH, before=check, stored=True, ready=folder)
    if months or read_snapshot(spark, paths["matches"]) is None:
        replace_snapshot(found, paths["matches"])
    return months


def append_keys(journal: DataFrame, path: str, preset: Preset) -> None:
    """Add the match keys of a batch that its months do not have yet."""
    keys = missing_in(keys_of_plays(journal, preset), path, ["match_key", *MONTH], MONTH, journal)
    if keys is not None:
        write_table(keys, path, MONTH, mode="append", gather=False)
