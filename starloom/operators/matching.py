"""Matching plays to the song catalog.

Plays carry `song`, `artist` and `length`; the catalog carries `title`, `artist_name`,
`duration`, `song_id` and `artist_id`. A hot title only makes one shuffle partition of plays
large, which AQE splits; with `pick="first"` the catalog is reduced to one row per key before
the join, so the join never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.numbers import fit_decimal


def catalog_of(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Catalog rows from the two dimensions."""
    names = artists.select("artist_id", "artist_name")
    return songs.join(names, "artist_id").select(
        "song_id", "title", "artist_id", "duration", "artist_name"
    )


def match_plays(
    plays: DataFrame,
    catalog: DataFrame,
    *,
    duration_scale: int | None = 5,
    duration_mode: str = "round",
    how: str = "left",
    pick: str = "all",
) -> DataFrame:
    """Add song_id and artist_id by title and artist name, and by duration at a scale.

    how: "left" keeps unmatched plays with NULL ids, "inner" drops them. pick: "all" matches,
    or the "first" by song_id and artist_id. Both durations are fitted to one decimal type
    before they are compared.
    """
    keys: dict[str, Column] = {"_title": F.col("title"), "_artist": F.col("artist_name")}
    play_keys: dict[str, Column] = {"_title": F.col("song"), "_artist": F.col("artist")}
    if duration_scale is not None:
        keys["_duration"] = fit_decimal(F.col("duration"), duration_scale, duration_mode)
        play_keys["_duration"] = fit_decimal(F.col("length"), duration_scale, duration_mode)
    known = catalog.select(*[c.alias(k) for k, c in keys.items()], "song_id", "artist_id")
    if pick == "first":
        known = (
            known.groupBy(*keys)
            .agg(F.min(F.struct("song_id", "artist_id")).alias("_first"))
            .select(*keys, "_first.song_id", "_first.artist_id")
        )
    elif pick != "all":
        raise ValueError(f"pick must be 'all' or 'first', not {pick!r}")
    return plays.withColumns(play_keys).join(known, list(keys), how).drop(*keys)


def match_plays_two_step(
    plays: DataFrame, songs: DataFrame, artists: DataFrame, strict: bool = False
) -> DataFrame:
    """Inner join to songs on title, then to artists on name.

    Without `strict` the two joins are independent, so the song may belong to another artist;
    with it the song's artist must be the matched one.
    """
    titles = songs.select(
        F.col("title").alias("_title"), "song_id", F.col("artist_id").alias("_song_artist")
    )
    names = artists.select(F.col("artist_name").alias("_name"), "artist_id")
    by_title = plays.join(titles, F.col("song") == F.col("_title"))
    cond = F.col("artist") == F.col("_name")
    if strict:
        cond = cond & (F.col("_song_artist") == F.col("artist_id"))
    return by_title.join(names, cond).drop("_title", "_name", "_song_artist")
