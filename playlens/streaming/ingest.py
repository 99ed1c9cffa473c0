"""Recently-played polls: flattening, look-back, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X


def flatten_polls(polls: DataFrame, since=None) -> DataFrame:
    """One row per reported play, for batch and streaming frames alike. Missing fields take defaults; a
    play without a readable time is dropped, as is one before ``since``."""
    items = polls.select("user_id", F.explode("items").alias("i"))
    artists = F.filter("i.track.artists", lambda a: a["name"].isNotNull() & (a["name"] != ""))
    artist = F.coalesce(F.try_element_at(artists, F.lit(1))["name"], F.lit("Unknown Artist"))
    song = F.coalesce("i.track.name", F.lit("Unknown Track"))
    out = items.select(
        "user_id",
        F.col("i.played_at").alias("played_at_str"),
        F.try_to_timestamp("i.played_at").alias("played_at"),
        F.coalesce("i.track.id", F.concat(song, F.lit("::"), artist)).alias("track_id"),
        song.alias("song_name"),
        artist.alias("artist_name"),
        F.coalesce("i.track.album.name", F.lit("Unknown Album")).alias("album_name"),
        X.round_even(F.coalesce("i.track.duration_ms", F.lit(180000)) / 1000.0, 1).alias("duration_sec"),
    ).where(F.col("played_at").isNotNull())
    return out if since is None else out.where(F.col("played_at") >= since)


def dedup_stream(plays: DataFrame, look_back: str = "1 hour", keys=("user_id", "played_at"), time: str = "played_at") -> DataFrame:
    """Overlapping polls repeat plays; the first report wins while the watermark covers the look-back.
    A report older than the look-back is late and ignored."""
    return plays.withWatermark(time, look_back).dropDuplicatesWithinWatermark(list(keys))
