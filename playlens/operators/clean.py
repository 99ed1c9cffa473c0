"""Cleaning of raw play logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.totals import with_total

# --- fixed values: source names and their canonical names, private / non-music columns ------
CANONICAL = {
    "master_metadata_track_name": "song_name",
    "master_metadata_album_artist_name": "artist_name",
    "master_metadata_album_album_name": "album_name",
    "ts": "time_stamp",
    "conn_country": "country",
}
PRIVATE = [
    "ip_addr", "episode_name", "episode_show_name", "spotify_episode_uri",
    "audiobook_title", "audiobook_uri", "audiobook_chapter_uri", "audiobook_chapter_title",
]
WIDE_PREFIX = "genre_"


def label_skip(df: DataFrame) -> DataFrame:
    value = X.is_skip() if "reason_end" in df.columns else F.lit(0)
    return df.withColumn("skipped", value)


def seconds_from_ms(df: DataFrame) -> DataFrame:
    if "ms_played" not in df.columns:
        return df
    return df.withColumn("sec_played", X.ms_to_seconds("ms_played")).drop("ms_played")


def rename_canonical(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in CANONICAL.items() if k in df.columns})


def drop_non_music(df: DataFrame, subset=("song_name", "artist_name")) -> DataFrame:
    return df.dropna(subset=[c for c in subset if c in df.columns])


def drop_private(df: DataFrame) -> DataFrame:
    return df.drop(*PRIVATE)


def standardize_platform(df: DataFrame) -> DataFrame:
    if "platform" not in df.columns:
        return df
    return df.withColumn("platform", X.platform_family("platform"))


def clean_plays(df: DataFrame) -> DataFrame:
    """Raw log to canonical plays: one projection and one filter, nothing shuffles."""
    for step in (label_skip, seconds_from_ms, rename_canonical, drop_non_music, drop_private, standardize_platform):
        df = df.transform(step)
    return df


def parse_time(df: DataFrame, column: str = "time_stamp", zone: str | None = None) -> DataFrame:
    parsed = F.to_timestamp(F.col(column))
    return df.withColumn(column, X.localize(parsed, zone) if zone else parsed)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """One aggregate finds the empty columns; the driver sees one row of counts."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if row[c] > 0])


def calendar_fields(df: DataFrame, ts: str = "time_stamp") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year(ts),
            "quarter_label": X.quarter_label(ts),
            "month": F.month(ts),
            "day_of_month": F.dayofmonth(ts),
            "hour_of_day": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "day_name": X.day_name(ts),
            "decimal_hour": X.decimal_hour(ts),
        }
    )


def flags_to_int(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: X.flag(c) for c in columns if c in df.columns})


def exact_dedup(df: DataFrame) -> DataFrame:
    """Identical rows collapse; grouping on all columns spreads copies only as far as values differ,
    and the partial aggregate removes copies before the shuffle."""
    return df.dropDuplicates()


def platform_flags(df: DataFrame) -> DataFrame:
    names = ["android", "windows", "linux"]
    if "platform" not in df.columns:
        return df.withColumns({f"platform_{n}": F.lit(0) for n in names})
    p = F.lower(F.col("platform"))
    return df.withColumns({f"platform_{n}": F.coalesce((p == n).cast("int"), F.lit(0)) for n in names})


def sentinel_keys(df: DataFrame) -> DataFrame:
    """Null grouping keys become 'unknown'; the primary tag is the first one, lower-cased."""
    first = F.trim(F.lower(F.try_element_at(F.col("tags"), F.lit(1))))
    return df.withColumns(
        {
            "album_key": F.coalesce("album_name", F.lit("unknown")),
            "reason_key": F.coalesce("reason_start", F.lit("unknown")),
            "genre_key": F.when(F.length(first) > 0, first).otherwise("unknown"),
        }
    )


def lump_rare(df: DataFrame, column: str, share: float = 0.02) -> DataFrame:
    """Value counts with the values below ``share`` of all rows merged into 'Other'."""
    all_ = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("_known"))
    counts = with_total(all_, "n").where("_known > 0")
    kept = F.when(F.col("n") >= F.col("_total") * share, F.col(column)).otherwise("Other")
    return counts.groupBy(kept.alias(column)).agg(F.sum("n").alias("plays"))


def tags_to_text(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.concat_ws(", ", F.transform("tags", lambda t: F.regexp_replace(t, "^genre_", ""))))


def text_to_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.when(F.col("tags") == "", F.array().cast("array<string>")).otherwise(F.split("tags", ", ")))


def drop_wide_indicators(df: DataFrame, keep=("genre_smoothed_skip_rate",)) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(WIDE_PREFIX) and c not in keep])
