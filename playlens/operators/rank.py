"""Ranking tables: entity (and period) totals, cut globally or per period.

Totals use map-side partial aggregation. The global cut is TakeOrderedAndProject; the per-period cut is
a ``row_number`` filter, which Spark turns into a per-task group limit *before* the shuffle, so a
period that owns most rows ships at most ``n`` rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X

PLAYS, SECONDS = "play_counts", "total_sec_played"

PERIODS = {
    "year": lambda ts="time_stamp": {"year": F.year(ts)},
    "month": lambda ts="time_stamp": {"period": X.month_start(ts)},
    "day": lambda ts="time_stamp": {"period": F.to_date(F.col(ts))},
    "month_of_year": lambda ts="time_stamp": {"month": F.month(ts)},
    "season": lambda ts="time_stamp": {"season": X.season(ts)},
    "season_year": lambda ts="time_stamp": {"year": F.year(ts), "season": X.season(ts)},
}


def period_columns(period: str | None) -> dict[str, Column]:
    return {} if period is None else PERIODS[period]()


def totals(plays: DataFrame, entity: list[str], period: str | None = None) -> DataFrame:
    """play_counts and total_sec_played per entity and period; rows with a null key are dropped."""
    cols = period_columns(period)
    known = plays.dropna(subset=entity)
    return (known.withColumns(cols) if cols else known).groupBy(*cols, *entity).agg(
        F.count("song_name").alias(PLAYS), F.sum("sec_played").alias(SECONDS)
    )


def topk(df: DataFrame, by: str, ties: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def topn_per_group(df: DataFrame, group: list[str], by: str, ties: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col(by).desc(), *ties)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_entities(plays: DataFrame, entity: list[str], by: str = PLAYS, n: int = 10) -> DataFrame:
    top = topk(totals(plays, entity), by, entity, n)
    return top.withColumn("total_time", X.duration_text(SECONDS))


def top_per_period(plays: DataFrame, entity: list[str], period: str, by: str = PLAYS, n: int = 10) -> DataFrame:
    group = list(period_columns(period))
    top = topn_per_group(totals(plays, entity, period), group, by, entity, n)
    return top.withColumn("total_time", X.duration_text(SECONDS))


def obsession(plays: DataFrame, n: int = 10) -> DataFrame:
    """Most plays of one song on one calendar day."""
    daily = totals(plays, ["song_name", "artist_name"], "day")
    return daily.orderBy(F.col(PLAYS).desc(), "period", "song_name", "artist_name").limit(n)


def exploded_tags(plays: DataFrame) -> DataFrame:
    return plays.withColumn("tag", F.explode(F.array_distinct("tags")))


def tag_totals(plays: DataFrame, period: str | None = None) -> DataFrame:
    cols = period_columns(period)
    df = exploded_tags(plays.withColumns(cols) if cols else plays)
    return df.groupBy(*cols, "tag").agg(F.sum("sec_played").alias("total_seconds"), F.count(F.lit(1)).alias("total_plays"))


def genre_listened(plays: DataFrame, period: str | None = None, n: int = 1) -> DataFrame:
    if period is None:
        return tag_totals(plays).withColumn("total_time", X.duration_text("total_seconds"))
    return topn_per_group(tag_totals(plays, period), list(period_columns(period)), "total_seconds", ["tag"], n)


def first_plays(plays: DataFrame, key: str = "song_name") -> DataFrame:
    """First play per key by (time, id): an aggregate, so a hot key costs one partial row per task."""
    first = F.min_by(F.struct("time_stamp", "tags"), F.struct("time_stamp", "event_id"))
    return plays.groupBy(key).agg(first.alias("f")).select(key, "f.time_stamp", "f.tags")


def genre_explored(plays: DataFrame, period: str | None = None, n: int = 1) -> DataFrame:
    cols = period_columns(period)
    first = first_plays(plays)
    df = exploded_tags(first.withColumns(cols) if cols else first)
    counts = df.groupBy(*cols, "tag").agg(F.count(F.lit(1)).alias("songs_explored"))
    return counts if not cols else topn_per_group(counts, list(cols), "songs_explored", ["tag"], n)
