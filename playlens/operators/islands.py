"""Gaps and islands over calendar periods.

Every window here runs over *distinct* (entity, period) rows. An entity has at most one row per day,
month or year, so a partition is bounded by the calendar, however many plays the entity has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.rank import topn_per_group

UNITS = {
    "years": lambda ts="time_stamp": F.year(ts),
    "months": lambda ts="time_stamp": X.abs_month(ts),
    "days": lambda ts="time_stamp": F.unix_date(F.to_date(ts)),
}


def active_periods(plays: DataFrame, keys: list[str], unit: str) -> DataFrame:
    """One row per key and period with its plays; ``p`` is a running period number."""
    return plays.dropna(subset=keys).groupBy(*keys, UNITS[unit]().cast("int").alias("p")).agg(F.count(F.lit(1)).alias("plays"))


def islands(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of consecutive periods: period number minus row number is constant inside a run."""
    w = Window.partitionBy(*keys).orderBy("p")
    tagged = periods.withColumn("_run", F.col("p") - F.row_number().over(w))
    return tagged.groupBy(*keys, "_run").agg(
        F.count(F.lit(1)).alias("length"), F.min("p").alias("first_p"), F.max("p").alias("last_p"), F.sum("plays").alias("plays")
    ).drop("_run")


def month_date(p: Column) -> Column:
    """First day of an absolute month number (year * 12 + month)."""
    return F.make_date(F.floor((p - 1) / 12).cast("int"), ((p - 1) % 12 + 1).cast("int"), F.lit(1))


def artist_month_streaks(plays: DataFrame, keys=("artist_name",)) -> DataFrame:
    runs = islands(active_periods(plays, list(keys), "months"), list(keys))
    return runs.select(
        *keys,
        F.col("length").alias("consecutive_months"),
        month_date(F.col("first_p")).alias("start_month"),
        month_date(F.col("last_p")).alias("end_month"),
    )


def longest_streak(plays: DataFrame, entity: str, unit: str) -> DataFrame:
    """Best run per entity: longest first, then most plays inside it, then the earliest."""
    runs = islands(active_periods(plays, [entity], unit), [entity])
    better = F.struct("length", "plays", (-F.col("first_p")).alias("early"))
    best = runs.groupBy(entity).agg(F.max(better).alias("b"))
    return best.select(entity, F.col("b.length").alias(f"consecutive_{unit}"), F.col("b.plays").alias("total_plays_in_streak"))


def listening_day_streaks(plays: DataFrame, n: int = 10) -> DataFrame:
    """Per user, the ``n`` longest runs of consecutive active days."""
    runs = islands(active_periods(plays, ["user_id"], "days"), ["user_id"])
    top = topn_per_group(runs, ["user_id"], "length", ["first_p"], n)
    return top.select(
        "user_id",
        "rank",
        F.col("length").alias("consecutive_days"),
        F.date_from_unix_date("first_p").alias("streak_start"),
        F.date_from_unix_date("last_p").alias("streak_end"),
    )


def silent_breaks(plays: DataFrame, n: int = 10) -> DataFrame:
    """Per user, the ``n`` longest breaks: last active day, next active day, silent days between."""
    days = active_periods(plays, ["user_id"], "days")
    nxt = F.lead("p").over(Window.partitionBy("user_id").orderBy("p"))
    gaps = days.withColumn("next_p", nxt).withColumn("silent_days", F.col("next_p") - F.col("p") - 1)
    top = topn_per_group(gaps.where(F.col("silent_days") > 0), ["user_id"], "silent_days", ["p"], n)
    return top.select(
        "user_id",
        "rank",
        "silent_days",
        F.date_from_unix_date("p").alias("break_start"),
        F.date_from_unix_date("next_p").alias("break_end"),
    )


def silent_days(plays: DataFrame) -> DataFrame:
    """Per user, the calendar days between first and last play, and how many had no play."""
    days = active_periods(plays, ["user_id"], "days")
    out = days.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("active_days"), (F.max("p") - F.min("p") + 1).cast("bigint").alias("calendar_days")
    )
    silent = F.col("calendar_days") - F.col("active_days")
    return out.withColumns({"silent_days": silent, "silent_share": X.percent(silent, F.col("calendar_days"), 1)})


def silent_dates(plays: DataFrame) -> DataFrame:
    """The silent days themselves: each user's calendar minus the user's active days. Plays without a user are one user."""
    active = plays.select("user_id", F.to_date("time_stamp").alias("day")).distinct()
    span = active.groupBy("user_id").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = span.select("user_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    seen = active.select(F.col("user_id").alias("_user"), F.col("day").alias("_day"))
    return spine.join(seen, F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("day") == F.col("_day")), "left_anti")


def hiatus(plays: DataFrame, unit: str, entity: str = "artist_name") -> DataFrame:
    """Longest gap between consecutive active periods of an entity, minus one; needs two periods."""
    w = Window.partitionBy(entity).orderBy("p")
    gaps = active_periods(plays, [entity], unit).withColumn("gap", F.col("p") - F.lag("p").over(w) - 1)
    return gaps.where(F.col("gap").isNotNull()).groupBy(entity).agg(F.max("gap").cast("bigint").alias(f"longest_silent_{unit}"))
