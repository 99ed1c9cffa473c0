"""Causal per-play features: each value uses strictly earlier plays of the same user only."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import clean
from playlens.operators.ordered import OrderedRows, lag_struct, r_count, r_max, r_sum, time_lookback
from playlens.operators.sessions import US, ordered_plays

# --- fixed values: the model's feature columns ------------------------------------------------
FEATURE_COLUMNS = [
    "artist_smoothed_skip_rate", "song_smoothed_skip_rate", "genre_smoothed_skip_rate",
    "album_smoothed_skip_rate", "reason_start_smoothed_skip_rate", "is_cold_start_artist",
    "seconds_since_last_skip", "skips_last_3m", "skips_last_15m", "previous_song_skipped",
    "consecutive_listens_streak", "platform_android", "platform_windows", "shuffle_mode",
    "is_session_start", "hour_of_day", "day_of_week", "hour_sin", "hour_cos",
]
ENTITY_KEYS = {
    "artist": "artist_name", "song": "song_name", "genre": "genre_key",
    "album": "album_key", "reason_start": "reason_key",
}
SMOOTHING = 20


def labelled(plays: DataFrame) -> DataFrame:
    return clean.sentinel_keys(plays).withColumn("is_skip", X.is_skip())


def prior_rate(skips: Column, plays: Column) -> Column:
    return skips / F.greatest(plays, F.lit(1))


def smoothed(skips: Column, plays: Column, prior: Column, weight: int = SMOOTHING) -> Column:
    return (skips + prior * weight) / (plays + weight)


def with_prior(plays: DataFrame, columns: Sequence[str] = ("*",)) -> OrderedRows:
    """``past_plays``, ``past_skips`` and their rate ``rolling_global_skip_rate`` before each play; of the plays only ``columns`` are ordered."""
    rows = ordered_plays(labelled(plays).select(*columns), sized_by=plays).running({"past_plays": r_count(), "past_skips": r_sum(F.col("is_skip"))})
    return rows.with_columns({"rolling_global_skip_rate": prior_rate(F.col("past_skips"), F.col("past_plays"))})


def entity_history(names) -> list:
    """Running plays and skips before each play, per entity of the user."""
    return [
        ((ENTITY_KEYS[n],), {f"{n}_past_plays": r_count(), f"{n}_past_skips": r_sum(F.col("is_skip"))}) for n in names
    ]


def entity_rate(name: str, prior: Column, weight: int = SMOOTHING) -> Column:
    return smoothed(F.col(f"{name}_past_skips"), F.col(f"{name}_past_plays"), prior, weight)


def global_prior(plays: DataFrame) -> DataFrame:
    needed = ["user_id", "event_id", "time_stamp", "is_skip"]  # a chunk of a large key is written with all its columns
    return with_prior(plays, needed).rows(["user_id", "event_id", "past_plays", "past_skips", "rolling_global_skip_rate"])


def target_encode(plays: DataFrame, name: str, weight: int = SMOOTHING) -> DataFrame:
    """Smoothed skip rate of one entity with the expanding prior."""
    rows = ordered_plays(labelled(plays), sized_by=plays).running_many(
        [((), {"past_plays": r_count(), "past_skips": r_sum(F.col("is_skip"))}), *entity_history([name])]
    )
    prior = prior_rate(F.col("past_skips"), F.col("past_plays"))
    out = rows.with_columns({f"{name}_smoothed_skip_rate": entity_rate(name, prior, weight)})
    return out.rows(["user_id", "event_id", f"{name}_past_plays", f"{name}_past_skips", f"{name}_smoothed_skip_rate"])


def target_rates(plays: DataFrame, names: Sequence[str], columns: Sequence[str], weight: int = SMOOTHING) -> DataFrame:
    """``columns`` of the plays and the smoothed skip rates of several entities, over one exchange and without a join."""
    rows = ordered_plays(labelled(plays), sized_by=plays).running_many(
        [((), {"past_plays": r_count(), "past_skips": r_sum(F.col("is_skip"))}), *entity_history(list(names))]
    )
    prior = prior_rate(F.col("past_skips"), F.col("past_plays"))
    out = rows.with_columns({f"{n}_smoothed_skip_rate": entity_rate(n, prior, weight) for n in names})
    return out.rows([*columns, *[f"{n}_smoothed_skip_rate" for n in names]])


def target_encode_static(plays: DataFrame, name: str, weight: int = SMOOTHING) -> DataFrame:
    """The variant whose prior is the whole table's mean (it sees the future; kept as an option)."""
    base = labelled(plays)
    totals = base.agg((F.sum("is_skip") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("m"))
    rows = ordered_plays(base, sized_by=plays).running_many(entity_history([name]))
    encoded = rows.rows().withColumn(f"{name}_smoothed_skip_rate", entity_rate(name, totals.scalar(), weight))
    return encoded.select("user_id", "event_id", f"{name}_smoothed_skip_rate")


def target_encode_multitag(plays: DataFrame, weight: int = SMOOTHING) -> DataFrame:
    """Mean over all tags of a play of the tag's smoothed rate from earlier plays. A tag listed twice
    counts twice, in the history and in the mean, so occurrences are summed per (play, tag) first."""
    rows = with_prior(plays).rows(["user_id", "event_id", "t_us", "is_skip", "rolling_global_skip_rate", "tags"])
    listed = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(F.lit("unknown")))
    tag = F.explode(F.transform(listed, lambda t: F.trim(F.lower(t)))).alias("tag")
    per_tag = (
        rows.select("user_id", "event_id", "t_us", "is_skip", "rolling_global_skip_rate", tag)
        .groupBy("user_id", "event_id", "t_us", "is_skip", "rolling_global_skip_rate", "tag")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    occurrences = plays.select("user_id", tag)  # sizes the keys without the windows above
    history = OrderedRows.by(per_tag, ["user_id", "tag"], ["t_us", "event_id"], sized_by=occurrences).running(
        {"tag_plays": r_sum(F.col("times")), "tag_skips": r_sum(F.col("times") * F.col("is_skip"))}
    ).rows()
    rate = smoothed(F.col("tag_skips"), F.col("tag_plays"), F.col("rolling_global_skip_rate"), weight)
    return history.groupBy("user_id", "event_id").agg(
        (F.sum(rate * F.col("times")) / F.sum("times")).alias("genre_multitag_skip_rate"), F.sum("times").alias("tag_count")
    )


def cold_start_artist(plays: DataFrame, min_plays: int = 3) -> DataFrame:
    rows = ordered_plays(labelled(plays), sized_by=plays).running({"artist_past_plays": r_count()}, ["artist_name"])
    cold = (F.col("artist_past_plays") < min_plays).cast("int")
    return rows.with_columns({"is_cold_start_artist": cold}).rows(["user_id", "event_id", "is_cold_start_artist"])


def momentum(rows: OrderedRows) -> OrderedRows:
    """Previous skip, streak since the last skip and session start. Needs ``past_plays`` and ``past_skips``."""
    rows = rows.with_columns({"_index": F.col("past_plays") + 1})
    rows = rows.running(
        {"_prev": lag_struct("t_us", "is_skip"), "_last_skip_index": r_max(F.when(F.col("is_skip") == 1, F.col("_index")))}
    )
    return rows.with_columns(momentum_columns())


def momentum_columns() -> dict[str, Column]:
    """From the previous play ``_prev`` and the number ``_last_skip_index`` of the last skip among the plays."""
    gap = F.col("t_us") - F.col("_prev.t_us")
    return {
        "previous_song_skipped": F.coalesce(F.col("_prev.is_skip"), F.lit(0)),
        "consecutive_listens_streak": F.col("past_plays") - F.coalesce("_last_skip_index", F.lit(0)),
        "is_session_start": F.coalesce((gap > 1200 * US).cast("int"), F.lit(1)),
    }


def momentum_features(plays: DataFrame) -> DataFrame:
    return momentum(with_prior(plays)).rows(
        ["user_id", "event_id", "previous_song_skipped", "consecutive_listens_streak", "is_session_start"]
    )


def look_back(rows: OrderedRows, windows_sec: dict[str, int]) -> OrderedRows:
    windows = {n: s * US for n, s in windows_sec.items()}
    out = time_lookback(rows, "t_us", "event_id", "is_skip", windows, "last_skip_us", "past_skips")
    return out.with_columns({"seconds_since_last_skip": seconds_since(F.col("t_us"), F.col("last_skip_us"))})


def seconds_since(now_us: Column, then_us: Column) -> Column:
    return F.coalesce((now_us - then_us) / US, F.lit(X.NO_SKIP_SECONDS))


def rolling_skips(plays: DataFrame, windows_sec: dict[str, int]) -> DataFrame:
    """Skips in (t - W, t] that precede the play; equal times count in row order."""
    return look_back(with_prior(plays), windows_sec).rows(["user_id", "event_id", *windows_sec])


def last_skip(plays: DataFrame) -> DataFrame:
    """Strict backward as-of: the latest skip before each play, and its distance."""
    return look_back(with_prior(plays), {}).rows(
        ["user_id", "event_id", F.timestamp_micros("last_skip_us").alias("last_skip_time"), "seconds_since_last_skip"]
    )


def feature_matrix(plays: DataFrame, extra_windows_sec: dict[str, int] | None = None) -> DataFrame:
    """All features in one pass: one exchange on the user, then windows that differ in sort only."""
    windows = {**MATRIX_WINDOWS, **(extra_windows_sec or {})}
    base = {"past_plays": r_count(), "past_skips": r_sum(F.col("is_skip"))}
    # the plain user windows come last, next to those of the later steps, which share their sort
    rows = ordered_plays(labelled(plays), sized_by=plays).running_many([*entity_history(ENTITY_KEYS), ((), base)])
    rows = look_back(momentum(rows), windows)
    return rows.with_columns(matrix_columns()).rows(matrix_names(windows))


MATRIX_WINDOWS = {"skips_last_3m": 180, "skips_last_15m": 900}


def matrix_columns() -> dict[str, Column]:
    """What follows from the play itself and the running counts of its user and entities."""
    prior = prior_rate(F.col("past_skips"), F.col("past_plays"))
    ts, hour = "time_stamp", F.hour("time_stamp")
    platform = X.platform_family("platform")
    return {
        "hour_of_day": hour,
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "year": F.year(ts),
        "hour_sin": X.hour_sin(hour),
        "hour_cos": X.hour_cos(hour),
        "rolling_global_skip_rate": prior,
        **{f"{n}_smoothed_skip_rate": entity_rate(n, prior) for n in ENTITY_KEYS},
        "is_cold_start_artist": (F.col("artist_past_plays") < 3).cast("int"),
        **{f"platform_{n}": (platform == n).cast("int") for n in ("android", "windows", "linux")},
        "shuffle_mode": X.flag("shuffle"),
    }


def matrix_names(windows: Sequence[str]) -> list[str]:
    return [
        "user_id", "event_id", "time_stamp", "is_skip", *matrix_columns(), "previous_song_skipped", "consecutive_listens_streak",
        "seconds_since_last_skip", *windows, "is_session_start",
    ]


def ensure_features(df: DataFrame) -> DataFrame:
    """Features as they are if all are present, else computed from the plays."""
    return df if set(FEATURE_COLUMNS) <= set(df.columns) else feature_matrix(df)


def any_null(columns) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
