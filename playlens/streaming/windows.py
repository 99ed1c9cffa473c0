"""Windowed aggregates over a play stream. Rows appear once their window is closed by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.audit import confusion_counts, metric_columns
from playlens.functions import exprs as X

TIME = "time_stamp"


def sessions(plays: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    w = F.session_window(TIME, gap)
    out = plays.withWatermark(TIME, delay).groupBy("user_id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("songs"), F.sum("sec_played").alias("total_sec"), F.max(TIME).alias("last_play")
    )
    return out.select("user_id", F.col("w.start").alias("session_start"), "last_play", "songs", "total_sec")


def tumbling_volume(plays: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    out = plays.withWatermark(TIME, delay).groupBy(F.window(TIME, size).alias("w")).agg(
        F.count(F.lit(1)).alias("plays"), F.sum("sec_played").alias("seconds"), F.sum("skipped").alias("skips")
    )
    return out.select(F.col("w.start").alias("window_start"), "plays", "seconds", "skips")


#: Rows that a window's listeners are dealt into: the state store is called for a window's bucket and not for each listener in it.
BUCKETS = 32


def sliding_skips(
    plays: DataFrame, size: str = "15 minutes", slide: str = "3 minutes", delay: str = "10 minutes", buckets: int = BUCKETS
) -> DataFrame:
    """One row for each listener and window. The state holds a window's (listener, skipped) in ``buckets`` rows, which
    are told apart by listener once the window is closed: listeners rarely play often in a window, so a row of state for each
    of them would be nearly one for each play and window. The plays of one bucket in one window must fit a row."""
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets))
    held = F.collect_list(F.struct("user_id", F.col("skipped").cast("long").alias("skipped")))
    closed = plays.withWatermark(TIME, delay).groupBy(F.window(TIME, size, slide).alias("w"), bucket.alias("b")).agg(held.alias("held"))
    rows = closed.select(F.col("w.start").alias("window_start"), F.sort_array("held").alias("p"))
    same = lambda i: F.get("p", i)["user_id"].eqNullSafe(F.get("p", i - 1)["user_id"])
    first = F.filter(F.sequence(F.lit(0), F.size("p") - 1), lambda i: (i == 0) | ~same(i))
    rows = rows.withColumn("first", first)
    runs = F.transform("first", lambda at, j: F.slice("p", at + 1, F.coalesce(F.get("first", j + 1), F.size("p")) - at))
    each = rows.select("window_start", F.explode(runs).alias("mine"))
    skips = F.aggregate("mine", F.lit(None).cast("long"), lambda n, x: F.coalesce(n + x["skipped"], n, x["skipped"]))
    return each.select(F.get("mine", 0)["user_id"].alias("user_id"), "window_start", F.size("mine").cast("long").alias("plays"), skips.alias("skips"))


def running_audit_metrics(audit: DataFrame) -> DataFrame:
    """The confusion matrix so far; complete mode, one row of state."""
    resolved = audit.where(F.col("status") == "RESOLVED")
    out = resolved.groupBy().agg(
        F.count(F.lit(1)).alias("total_evaluated"), *confusion_counts(),
        X.round_even(F.coalesce(F.sum("cdn_mb_saved"), F.lit(0.0)), 2).alias("mb_saved"),
    )
    return out.withColumns(metric_columns())
