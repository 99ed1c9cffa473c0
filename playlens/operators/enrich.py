"""Tag metadata and rate lookups.

No broadcast is forced here: Spark broadcasts a side when its measured size is under the session's
threshold, and otherwise sort-merge joins with AQE splitting skewed partitions of the play side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.totals import with_total

TRACK = ["artist_name", "song_name"]


def no_tags() -> Column:
    return F.array().cast("array<string>")


def tagged(c: str) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def dedup_meta(meta: DataFrame, keys=tuple(TRACK), order: str = "version") -> DataFrame:
    """One row per key, the one of lowest ``order``."""
    rest = [c for c in meta.columns if c not in keys]
    picked = meta.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("m"))
    return picked.select(*keys, "m.*")


def enrich_left(plays: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join on unique metadata keys: the row count of the plays never changes."""
    one = dedup_meta(meta).select(*TRACK, F.col("genres").alias("track_genres"))
    return plays.join(one, TRACK, "left")


def genre_cascade(plays: DataFrame, track_meta: DataFrame, artist_meta: DataFrame) -> DataFrame:
    """``genres``: the track's tags, else the artist's, else an empty list; ``genre_source`` says which."""
    artist = artist_meta.select("artist_name", F.col("genres").alias("artist_genres"))
    joined = enrich_left(plays, track_meta).join(artist, "artist_name", "left")
    source = F.when(tagged("track_genres"), "track").when(tagged("artist_genres"), "artist").otherwise("none")
    tags = (
        F.when(tagged("track_genres"), F.col("track_genres"))
        .when(tagged("artist_genres"), F.col("artist_genres"))
        .otherwise(no_tags())
    )
    return joined.withColumns({"genres": tags, "genre_source": source}).drop("track_genres", "artist_genres")


def frequent_tags(track_meta: DataFrame, min_tracks: int = 10) -> DataFrame:
    """Tags listed at least ``min_tracks`` times over the deduplicated tracks."""
    listed = dedup_meta(track_meta).select(F.explode("genres").alias("tag"))
    return listed.groupBy("tag").agg(F.count(F.lit(1)).alias("tracks")).where(F.col("tracks") >= min_tracks)


def keep_listed(df: DataFrame, keys: list[str], column: str, allowed: DataFrame) -> DataFrame:
    """``column`` reduced to allowed tags in their old order. Lists are rebuilt per row key, so a group is
    one row's list and a frequent tag only meets the (small) distinct tag set."""
    parts = df.select(*keys, F.posexplode(column).alias("pos", "tag")).join(allowed.select("tag"), "tag", "left_semi")
    rebuilt = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "tag"))).alias("_kept"))
    out = df.join(rebuilt, keys, "left")
    kept = F.transform("_kept", lambda s: s["tag"])
    return out.withColumn(column, F.coalesce(kept, no_tags())).drop("_kept")


def frequent_tag_filter(track_meta: DataFrame, artist_meta: DataFrame, min_tracks: int = 10) -> DataFrame:
    """Track tags cut to frequent ones; a track left empty takes its artist's frequent tags."""
    allowed = frequent_tags(track_meta, min_tracks)
    tracks = keep_listed(dedup_meta(track_meta).select(*TRACK, "genres"), TRACK, "genres", allowed)
    artists = keep_listed(artist_meta, ["artist_name"], "genres", allowed).select(
        "artist_name", F.col("genres").alias("_artist")
    )
    filled = tracks.join(artists, "artist_name", "left")
    return filled.withColumn(
        "genres", F.when(F.size("genres") > 0, F.col("genres")).otherwise(F.coalesce("_artist", no_tags()))
    ).drop("_artist")


def artist_top_tags(plays: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most played tags of each artist that has an untagged play."""
    missing = plays.where(~tagged("genres")).select("artist_name").distinct()
    known = plays.where(tagged("genres")).join(missing, "artist_name", "left_semi")
    counts = known.select("artist_name", F.explode(F.array_distinct("genres")).alias("tag")).groupBy("artist_name", "tag").agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("artist_name").orderBy(F.col("n").desc(), "tag")
    top = counts.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)
    listed = F.array_sort(F.collect_list(F.struct("rk", "tag")))
    return top.groupBy("artist_name").agg(F.transform(listed, lambda s: s["tag"]).alias("top_tags"))


def impute_artist_tags(plays: DataFrame, n: int = 3) -> DataFrame:
    filled = plays.join(artist_top_tags(plays, n), "artist_name", "left")
    tags = F.when(tagged("genres"), F.col("genres")).otherwise(F.coalesce("top_tags", no_tags()))
    source = F.when(tagged("genres"), F.col("genre_source")).when(tagged("top_tags"), "artist_top").otherwise("none")
    return filled.withColumns({"genres": tags, "genre_source": source}).drop("top_tags")


def flag_unknown(plays: DataFrame) -> DataFrame:
    return plays.withColumn("genres", F.when(tagged("genres"), F.col("genres")).otherwise(F.array(F.lit("unknown"))))


def missing_tracks(plays: DataFrame, track_meta: DataFrame) -> DataFrame:
    """Distinct (artist, song) without a metadata record."""
    return plays.select(*TRACK).distinct().join(track_meta.select(*TRACK), TRACK, "left_anti")


def missing_artists(track_meta: DataFrame, artist_meta: DataFrame) -> DataFrame:
    """Artists of tagless tracks that have no artist record."""
    empty = track_meta.where(~tagged("genres")).select("artist_name").distinct()
    return empty.join(artist_meta.select("artist_name"), "artist_name", "left_anti")


def genre_coverage(plays: DataFrame) -> DataFrame:
    """Plays per source of their tags, with the share of all plays."""
    out = plays.groupBy("genre_source").agg(F.count(F.lit(1)).alias("plays"))
    return with_total(out, "plays").withColumn("share", X.percent(F.col("plays"), F.col("_total"))).drop("_total")


# --- rate lookups ---------------------------------------------------------------------------------
def latest_rates(features: DataFrame, name: str, rate: str) -> DataFrame:
    """Latest rate per raw name, keyed by the trimmed lower-cased name. When names differ only by case
    the variant whose latest play is oldest wins."""
    latest = features.groupBy(name).agg(
        F.max_by(rate, F.struct("time_stamp", "event_id")).alias("rate"),
        F.max(F.struct("time_stamp", "event_id")).alias("at"),
    )
    return latest.groupBy(X.lookup_key(name).alias("lookup_key")).agg(F.min_by("rate", "at").alias("rate"))


def with_rates(df: DataFrame, artist_rates: DataFrame, song_rates: DataFrame, default: float = X.DEFAULT_SKIP_RATE) -> DataFrame:
    """song rate -> artist rate -> default, and a cold-start flag where the artist is unknown."""
    artists = artist_rates.select(F.col("lookup_key").alias("_ak"), F.col("rate").alias("_ar"))
    songs = song_rates.select(F.col("lookup_key").alias("_sk"), F.col("rate").alias("_sr"))
    joined = df.join(artists, X.lookup_key("artist_name") == F.col("_ak"), "left").join(
        songs, X.lookup_key("song_name") == F.col("_sk"), "left"
    )
    artist_rate = F.coalesce("_ar", F.lit(default))
    return joined.withColumns(
        {
            "is_cold_start_artist": F.col("_ak").isNull().cast("int"),
            "artist_smoothed_skip_rate": artist_rate,
            "song_smoothed_skip_rate": F.coalesce(F.col("_sr"), artist_rate),
        }
    ).drop("_ak", "_ar", "_sk", "_sr")


def new_events(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming records whose key is not stored yet, one per key. Null parts of a key equal each other."""
    known = stored.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)])
    return incoming.dropDuplicates(keys).join(known, same, "left_anti")
