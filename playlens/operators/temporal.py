"""Volume by calendar unit, heat maps, trends and discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import rank
from playlens.operators.totals import with_total


def history_summary(plays: DataFrame) -> DataFrame:
    return plays.agg(
        F.count(F.lit(1)).alias("plays"),
        F.to_date(F.min("time_stamp")).alias("first_day"),
        F.to_date(F.max("time_stamp")).alias("last_day"),
        F.sum("sec_played").alias("total_seconds"),
    ).withColumns({"total_hours": X.hours("total_seconds", 2), "total_time": X.duration_text("total_seconds")})


def volume(plays: DataFrame, period: str) -> DataFrame:
    cols = rank.period_columns(period)
    out = plays.withColumns(cols).groupBy(*cols).agg(
        F.count("song_name").alias("plays"), F.sum("sec_played").alias("total_seconds")
    )
    return out.withColumns({"hours": X.hours("total_seconds"), "total_time": X.duration_text("total_seconds")})


def volume_by(plays: DataFrame, **bucket: Column) -> DataFrame:
    """Plays, hours and share of all plays per bucket."""
    out = plays.withColumns(bucket).groupBy(*bucket).agg(
        F.count("song_name").alias("plays"), F.sum("sec_played").alias("total_seconds"), F.count(F.lit(1)).alias("_n")
    )
    share = X.percent(F.col("plays"), F.col("_total"))
    return with_total(out, "_n").withColumns({"hours": X.hours("total_seconds"), "share": share}).drop("_n", "_total")


def volume_daypart(plays: DataFrame) -> DataFrame:
    part = X.daypart(X.decimal_hour("time_stamp"))
    out = plays.groupBy(part.alias("daypart")).agg(F.count(F.lit(1)).alias("plays"))
    return out.withColumn("position", X.ordinal(F.col("daypart"), X.DAYPARTS))


def _hour_pivot(df: DataFrame, value: Column, prefix: str = "h") -> DataFrame:
    wide = df.groupBy(F.weekday("time_stamp").alias("weekday")).pivot("hour", list(range(24))).agg(value)
    return wide.withColumnsRenamed({str(h): f"{prefix}{h:02d}" for h in range(24)})


def traffic_heatmap(plays: DataFrame) -> DataFrame:
    return _hour_pivot(plays.withColumn("hour", F.hour("time_stamp")), F.count(F.lit(1)))


def skip_heatmap(plays: DataFrame) -> DataFrame:
    """Per weekday, the share of its skips that falls into each hour."""
    skips = plays.where(F.col("reason_end") == X.SKIP_REASON).withColumn("hour", F.hour("time_stamp"))
    wide = _hour_pivot(skips, F.count(F.lit(1)))
    return row_normalise(wide, [f"h{h:02d}" for h in range(24)])


def skip_rate_grid(plays: DataFrame) -> DataFrame:
    graded = plays.withColumn("hour", F.hour("time_stamp"))
    return _hour_pivot(graded, X.round_even(F.sum("skipped") / F.count("skipped") * 100, 4))


def row_normalise(wide: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Each listed column as a percentage of their row sum."""
    filled = wide.na.fill(0, subset=columns)
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return filled.select(
        *[c for c in wide.columns if c not in columns], *[X.percent(F.col(c), total, digits).alias(c) for c in columns]
    )


def daily_seconds(plays: DataFrame) -> DataFrame:
    """Seconds per day from the first to the last play, 0 where nothing was played. Each active day is followed by the
    idle days up to the next one, so the plays are read once; the window has one row per calendar day."""
    active = plays.where(F.col("time_stamp").isNotNull()).groupBy(F.to_date("time_stamp").alias("at")).agg(F.sum("sec_played").alias("sum"))
    until = F.coalesce(F.date_sub(F.lead("at").over(Window.partitionBy(F.lit(0)).orderBy("at")), 1), F.col("at"))
    days = active.withColumn("until", until).select("at", "sum", F.explode(F.sequence("at", "until")).alias("day"))
    return days.select("day", F.coalesce(F.when(F.col("day") == F.col("at"), F.col("sum")), F.lit(0)).alias("seconds"))


def trailing_mean(df: DataFrame, value: str, order: str, n: int) -> Column:
    """Mean of this and the previous ``n - 1`` rows. For calendar tables only (one row per day or month),
    whose size is bounded by the calendar and not by the plays."""
    w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(-(n - 1), 0)
    return F.sum(value).over(w) / F.count(value).over(w)


def daily_usage_trend(plays: DataFrame, window: int = 30) -> DataFrame:
    days = daily_seconds(plays)
    mean = trailing_mean(days, "seconds", "day", window)
    return days.select("day", X.hours("seconds", 4).alias("hours"), X.hours(mean, 4).alias("trend"))


def autoplay_reliance(plays: DataFrame, window: int = 3) -> DataFrame:
    passive = (F.col("reason_start") == X.DONE_REASON).cast("int")
    monthly = plays.groupBy(X.month_start("time_stamp").alias("month")).agg(
        F.count(F.lit(1)).alias("streams"), F.sum(F.coalesce(passive, F.lit(0))).alias("passive")
    )
    monthly = monthly.withColumn("ratio", F.col("passive") / F.col("streams") * 100)
    smooth = trailing_mean(monthly, "ratio", "month", window)
    return monthly.select(
        "month", "streams", "passive", X.round_even("ratio", 4).alias("ratio"), X.round_even(smooth, 4).alias("smooth_ratio")
    )


def seasonal_intensity(plays: DataFrame, n: int = 5) -> DataFrame:
    """Per year and top-n artist: plays divided by the months of each season."""
    per = rank.totals(plays, ["artist_name"], "season_year")
    yearly = per.groupBy("year", "artist_name").agg(F.sum("play_counts").alias("year_plays"))
    top = rank.topn_per_group(yearly, ["year"], "year_plays", ["artist_name"], n).drop("rank", "year_plays")
    kept = per.join(top, ["year", "artist_name"], "left_semi")
    wide = kept.groupBy("year", "artist_name").pivot("season", X.SEASONS).agg(F.sum("play_counts"))
    return wide.select(
        "year",
        "artist_name",
        *[X.round_even(F.coalesce(s, F.lit(0)) / X.SEASON_MONTHS[s], 4).alias(s.lower()) for s in X.SEASONS],
    )


def discovery_funnel(plays: DataFrame, reasons=("clickrow", "trackdone", "fwdbtn")) -> DataFrame:
    """New artists per quarter and first known start reason."""
    at = F.struct("time_stamp", "event_id")
    first = plays.groupBy("artist_name").agg(
        F.min("time_stamp").alias("first_time"),
        F.min_by("reason_start", F.when(F.col("reason_start").isNotNull(), at)).alias("reason_start"),
    )
    return (
        first.where(F.col("reason_start").isin(*reasons))
        .groupBy(X.quarter_label("first_time").alias("quarter"), "reason_start")
        .agg(F.count(F.lit(1)).alias("new_artists"))
    )
