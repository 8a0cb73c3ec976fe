"""Event files to three tables, each laid out for one question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.contracts import (
    EVENT_CSV, HISTORY_BY_SESSION, SONG_BY_ITEM_IN_SESSION, USERS_BY_SONG, TableContract,
)
from starloom.operators import merge
from starloom.operators.cleaning import drop_blank
from starloom.operators.layout import distribute_merged
from starloom.session import kept
from starloom.sources.files import scan_csv

# The columns of the cleaned union, in order.
CLEAN_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "sessionId", "song", "userId",
]


def clean_union(events: DataFrame) -> DataFrame:
    """Plays only, without the unneeded columns."""
    return drop_blank(events, "artist").select(*CLEAN_COLUMNS)


def typed_plays(events: DataFrame) -> DataFrame:
    """Plays under the names and types of the query tables, with the time as order."""
    return drop_blank(events, "artist").select(
        F.col("sessionId").try_cast("int").alias("session_id"),
        F.col("itemInSession").try_cast("int").alias("item_in_session"),
        F.col("userId").try_cast("int").alias("user_id"),
        "artist",
        "song",
        F.col("length").try_cast("decimal(15,5)").alias("duration"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        F.col("ts").try_cast("double").alias("ts"),
    )


def _keyed(plays: DataFrame, contract: TableContract) -> DataFrame:
    """Rows of one query table: the newest row of a primary key stays."""
    key = list(contract.primary_key)
    rows = plays.select(*contract.column_names, "ts").dropna("any", subset=key)
    return merge.last_wins(rows, key, ["ts"]).select(*contract.column_names)


def song_by_item_in_session(plays: DataFrame) -> DataFrame:
    return _keyed(plays, SONG_BY_ITEM_IN_SESSION)


def history_by_session(plays: DataFrame) -> DataFrame:
    return _keyed(plays, HISTORY_BY_SESSION)


def users_by_song(plays: DataFrame) -> DataFrame:
    return _keyed(plays, USERS_BY_SONG)


BUILDERS = [
    (SONG_BY_ITEM_IN_SESSION, song_by_item_in_session),
    (HISTORY_BY_SESSION, history_by_session),
    (USERS_BY_SONG, users_by_song),
]


def build_query_tables(plays: DataFrame) -> dict[str, DataFrame]:
    return {contract.name: build(plays) for contract, build in BUILDERS}


def run_query_tables(spark: SparkSession, source: str, out: str) -> dict[str, str]:
    """CSV folder to three written tables; the typed plays are read from CSV once."""
    paths = {}
    with kept(typed_plays(scan_csv(spark, source, EVENT_CSV)), "typed-plays") as plays:
        for contract, build in BUILDERS:
            paths[contract.name] = f"{out}/{contract.name}"
            table = distribute_merged(plays, list(contract.cluster_by), list(contract.sort_by), build)
            table.write.mode("overwrite").parquet(paths[contract.name])
    return paths
