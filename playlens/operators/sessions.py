"""Inactivity sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.ordered import OrderedRows, lag_struct, r_sum
from playlens.operators.rank import topn_per_group

US = 1_000_000


def ordered_plays(plays: DataFrame, time: str = "time_stamp", sized_by: DataFrame | None = None) -> OrderedRows:
    """Plays per user in (time, id) order, with the time also as whole microseconds ``t_us``."""
    keyed = plays.withColumn("t_us", X.micros(time))
    return OrderedRows.by(keyed, ["user_id"], ["t_us", "event_id"], sized_by=plays if sized_by is None else sized_by)


def sessionize(plays: DataFrame, gap_sec: int = 1800, gap_from: str = "end") -> DataFrame:
    """``session_id`` per user, counting from 0. A play opens a session when the gap to the previous play
    exceeds ``gap_sec``; with ``gap_from='start'`` the gap is measured to the play's start time
    (time minus seconds played)."""
    begin = F.col("t_us") if gap_from == "end" else F.col("t_us") - F.col("sec_played").cast("bigint") * US
    gap = begin - F.col("_prev.t_us")
    return (
        ordered_plays(plays)
        .running({"_prev": lag_struct("t_us")})
        .with_columns({"is_new_session": F.coalesce((gap > gap_sec * US).cast("int"), F.lit(0))})
        .running({"session_id": r_sum(F.col("is_new_session"), inclusive=True)})
        .map(lambda d: d.drop("_prev"))
        .rows()
    )


def session_totals(plays: DataFrame, gap_sec: int = 1800, gap_from: str = "end") -> DataFrame:
    return sessionize(plays, gap_sec, gap_from).groupBy("user_id", "session_id").agg(
        F.min("time_stamp").alias("session_start"),
        F.max("time_stamp").alias("session_end"),
        F.sum("sec_played").alias("total_sec"),
        F.count("song_name").alias("songs"),
    )


def marathons(plays: DataFrame, gap_sec: int = 1800, n: int = 10) -> DataFrame:
    """The ``n`` longest sessions of all users by listened hours."""
    s = session_totals(plays, gap_sec).withColumn("total_hours", X.hours("total_sec", 2))
    return s.orderBy(F.col("total_sec").desc(), "user_id", "session_id").limit(n)


def binge_histogram(plays: DataFrame, gap_sec: int = 900, min_sec: int = 3600) -> DataFrame:
    s = session_totals(plays, gap_sec, "start").where(F.col("total_sec") >= min_sec)
    return s.groupBy(X.round_even(F.col("total_sec") / 3600).cast("int").alias("rounded_hours")).agg(
        F.count(F.lit(1)).alias("sessions")
    )


def session_quantiles(plays: DataFrame, gap_sec: int = 1800, points=(0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    """Exact quantiles of session seconds (as hours). Sessions are first counted per whole second, so the
    final aggregate holds one entry per distinct length."""
    per = session_totals(plays, gap_sec).groupBy("total_sec").agg(F.count(F.lit(1)).alias("n"))
    q = per.agg(F.percentile("total_sec", F.array(*[F.lit(p) for p in points]), F.col("n")).alias("q"), F.sum("n").alias("sessions"))
    names = [f"p{int(p * 100)}_hours" for p in points]
    return q.select("sessions", *[X.hours(F.col("q")[i], 4).alias(nm) for i, nm in enumerate(names)])


def silent_gaps(plays: DataFrame, gap_sec: int = 1800) -> DataFrame:
    """Gaps between a session's last play and the next session's first one, as a histogram in hours."""
    s = sessionize(plays, gap_sec)
    bounds = (
        s.groupBy("user_id", "session_id")
        .agg(F.min("t_us").alias("lo"), F.max("t_us").alias("hi"))
        .withColumns({"t_us": F.col("lo"), "event_id": F.col("session_id")})
    )
    # a user has no more sessions than plays, and the plays per user are already known
    prev = OrderedRows.by(bounds, ["user_id"], ["t_us", "event_id"], sized_by=plays).running({"_prev": lag_struct("hi")}).rows()
    gap = F.col("lo") - F.col("_prev.hi")
    gaps = prev.where(F.col("_prev").isNotNull()).select(F.floor(gap / (3600 * US)).alias("gap_hours"), gap.alias("gap_us"))
    return gaps.groupBy("gap_hours").agg(F.count(F.lit(1)).alias("gaps"), F.sum(F.floor(F.col("gap_us") / US)).alias("gap_seconds"))


def longest_sessions_per_user(plays: DataFrame, gap_sec: int = 1800, n: int = 3) -> DataFrame:
    return topn_per_group(session_totals(plays, gap_sec), ["user_id"], "total_sec", ["session_id"], n)
