"""Session replay: infer what happened to each finished play and rebuild the features known at its start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.enrich import with_rates
from playlens.operators.ordered import OrderedRows, lag_struct, r_count, r_last, r_max, r_sum, time_lookback
from playlens.operators.sessions import US, ordered_plays

IDLE_SEC = 600
#: A play that passes this many seconds has settled: it clears the previous-skip flag.
SETTLED_SEC = 45.0


def session_clock(rows: OrderedRows, duration: Column, idle_sec: int = IDLE_SEC) -> OrderedRows:
    """Adds the gap to the previous finished play, the idle flag and the start time ``start_us``."""
    rows = rows.running({"_prev": lag_struct("t_us")})
    gap = F.when(F.col("_prev").isNotNull(), F.greatest(F.lit(0), F.col("t_us") - F.col("_prev.t_us")))
    idle = F.coalesce(gap > idle_sec * US, F.lit(True))
    return rows.with_columns(
        {
            "gap_us": gap,
            "is_idle_break": idle.cast("int"),
            "start_us": F.when(idle, F.col("t_us") - (duration * US).cast("bigint")).otherwise(F.col("_prev.t_us")),
        }
    ).map(lambda d: d.drop("_prev"))


def outcome_columns(rows: OrderedRows, duration: Column, short_track: str = "duration") -> OrderedRows:
    elapsed = F.col("gap_us") / US
    active = F.col("is_idle_break") == 0
    skipped = active & (elapsed < X.completion_cutoff(duration, short_track))
    played = F.when(active, X.round_even(F.least(elapsed, duration), 1)).otherwise(duration)
    return rows.with_columns({"actual_skipped": skipped.cast("int"), "actual_played_sec": played})


def infer_outcome(recent: DataFrame, idle_sec: int = IDLE_SEC, short_track: str = "duration") -> DataFrame:
    d = F.col("duration_sec")
    rows = outcome_columns(session_clock(ordered_plays(recent, "played_at"), d, idle_sec), d, short_track)
    return rows.rows(["user_id", "event_id", "is_idle_break", "actual_skipped", "actual_played_sec"])


def session_state(rows: OrderedRows, windows_sec: dict[str, int], memory_sec: int = 900) -> OrderedRows:
    """What the session knew when each play began. State is cleared by an idle break; skip times are the
    end times of skipped plays, seen from the end of the previous play."""
    flag = F.col("actual_skipped")
    rows = rows.running({"session_id": r_sum(F.col("is_idle_break"), inclusive=True)})
    per = ["session_id"]
    rows = rows.running({"_n": r_count(), "_s": r_sum(flag)}, per).with_columns({"_i": F.col("_n") + 1})
    # windows are closed on both ends here, hence one microsecond more than (t - W, t]
    spans = {f"_w_{n}": s * US + 1 for n, s in windows_sec.items()}
    rows = time_lookback(rows, "t_us", "event_id", "actual_skipped", spans, "_strict", "_s", per)
    rows = rows.with_columns({k: F.col(k) + flag for k in spans})
    rows = rows.running(
        {
            "_before": lag_struct("t_us", "actual_skipped", *spans),
            "_skip_i": r_max(F.when(flag == 1, F.col("_i"))),
            "_skip_us": r_max(F.when(flag == 1, F.col("t_us"))),
        },
        per,
    )
    since = (F.col("_before.t_us") - F.col("_skip_us")) / US
    streak = F.col("_n") - F.coalesce("_skip_i", F.lit(0))
    previous = F.coalesce("_before.actual_skipped", F.lit(0))
    return rows.with_columns(
        {
            **{n: F.coalesce(F.col(f"_before._w_{n}"), F.lit(0)).cast("bigint") for n in windows_sec},
            "seconds_since_last_skip": F.when(since <= memory_sec, since).otherwise(F.lit(X.NO_SKIP_SECONDS)),
            "previous_song_skipped": previous,
            "consecutive_listens_streak": streak,
            "reason_start": F.when(previous == 1, X.SKIP_REASON).otherwise(X.DONE_REASON),
            "is_session_start": ((F.col("is_idle_break") == 1) | (streak == 0)).cast("int"),
        }
    )


REPLAY_WINDOWS = {"skips_last_3m": 180, "skips_last_15m": 900}


def feature_columns(df: DataFrame, artist_rates: DataFrame, song_rates: DataFrame) -> DataFrame:
    """The serving-side feature vector: lookups for content, constants for the headless device."""
    start = F.timestamp_micros("start_us")
    hour = F.hour(start)
    rated = with_rates(df, artist_rates, song_rates)
    return rated.withColumns(
        {
            "genre_smoothed_skip_rate": F.col("artist_smoothed_skip_rate"),
            "album_smoothed_skip_rate": F.col("artist_smoothed_skip_rate"),
            "reason_start_smoothed_skip_rate": X.reason_risk("reason_start"),
            "platform_android": F.lit(0),
            "platform_windows": F.lit(1),
            "shuffle_mode": F.lit(0),
            "hour_of_day": hour,
            "day_of_week": F.weekday(start),
            "hour_sin": X.hour_sin(hour),
            "hour_cos": X.hour_cos(hour),
        }
    )


def session_replay_features(
    recent: DataFrame, artist_rates: DataFrame, song_rates: DataFrame, idle_sec: int = IDLE_SEC
) -> DataFrame:
    d = F.col("duration_sec")
    rows = outcome_columns(session_clock(ordered_plays(recent, "played_at"), d, idle_sec), d)
    return feature_columns(session_state(rows, REPLAY_WINDOWS).rows(), artist_rates, song_rates)


def audit_training_features(
    audit: DataFrame, artist_rates: DataFrame, song_rates: DataFrame, idle_sec: int = IDLE_SEC, default_duration: float = 180.0
) -> DataFrame:
    """The same features with outcomes taken from the audit log."""
    known = audit.withColumns(
        {
            "duration_sec": F.coalesce(F.nullif(F.col("total_duration_sec"), F.lit(0.0)), F.lit(default_duration)),
            "actual_skipped": F.coalesce("actual_skipped", F.lit(0)),
        }
    )
    rows = session_clock(ordered_plays(known, "played_at", audit), F.col("duration_sec"), idle_sec)
    out = feature_columns(session_state(rows, REPLAY_WINDOWS).rows(), artist_rates, song_rates)
    return out.withColumn("is_skip", F.col("actual_skipped"))


def grade(df: DataFrame) -> DataFrame:
    """Confusion class and bandwidth saved, from predicted_skip, actual_skipped and actual_played_sec."""
    return df.withColumns(
        {
            "evaluation_result": X.grade("predicted_skip", "actual_skipped"),
            "cdn_mb_saved": X.mb_saved("predicted_skip", "actual_skipped", "actual_played_sec"),
        }
    )


def decide(df: DataFrame, prob: str = "predicted_prob", threshold: float = 0.45) -> DataFrame:
    return df.withColumns(
        {"predicted_skip": (F.col(prob) >= threshold).cast("int"), "risk_tier": X.risk_tier_3(prob, threshold)}
    )


# --- live progress polls ----------------------------------------------------------------------------
def track_changes(progress: DataFrame, short_track: str = "flat30") -> OrderedRows:
    """Active polls with the previous active poll beside them. A change of track, or the same track
    jumping back by more than 5 s, closes the previous play; idle polls do not break the chain."""
    active = progress.where(F.col("status") == "ACTIVE")
    rows = ordered_plays(active, "poll_ts", progress).running({"before": lag_struct("track_id", "progress_sec", "duration_sec")})
    restarted = F.col("progress_sec") < F.col("before.progress_sec") - 5.0
    changed = F.col("before").isNull() | (F.col("track_id") != F.col("before.track_id")) | restarted
    closes = changed & F.col("before").isNotNull()
    skipped = closes & (F.col("before.progress_sec") < X.completion_cutoff("before.duration_sec", short_track))
    return rows.with_columns(
        {"is_track_change": changed.cast("int"), "closes_play": closes.cast("int"), "was_skipped": skipped.cast("int")}
    )


def closed_plays(progress: DataFrame) -> DataFrame:
    rows = track_changes(progress).rows().where(F.col("closes_play") == 1)
    return rows.select(
        "user_id",
        "event_id",
        F.col("before.track_id").alias("track_id"),
        F.col("before.progress_sec").alias("listen_sec"),
        F.col("before.duration_sec").alias("total_sec"),
        "was_skipped",
    )


def mood(skips_3m: Column, since: Column, progress: Column) -> Column:
    return (
        F.when((skips_3m >= 2) & (progress < 45.0), "SKIP_SPREE")
        .when(((skips_3m >= 1) | (since < 45.0)) & (progress < 60.0), "RESTLESS")
        .otherwise("CALM_FLOW")
    )


def session_mood(progress: DataFrame) -> DataFrame:
    """Mood at every active poll; the skip noticed at a poll already counts for it. A play that passes
    45 s without a change clears the previous-skip flag."""
    flag = F.col("was_skipped")
    rows = track_changes(progress).running({"_s": r_sum(flag)})
    spans = {"_w3": 180 * US + 1, "_w15": 900 * US + 1}
    rows = time_lookback(rows, "t_us", "event_id", "was_skipped", spans, "_strict", "_s")
    # the flag's last writer: a change sets it to that play's outcome, settling past 45 s clears it
    writes = F.when(F.col("is_track_change") == 1, flag).when(F.col("progress_sec") >= SETTLED_SEC, F.lit(0))
    rows = rows.running(
        {
            "_skip_us": r_max(F.when(flag == 1, F.col("t_us")), inclusive=True),
            "_flag": r_last(writes, inclusive=True),
        }
    )
    since = (F.col("t_us") - F.col("_skip_us")) / US
    skips_3m, skips_15m = (F.col("_w3") + flag), (F.col("_w15") + flag)
    known = F.when(since <= 900, since).otherwise(F.lit(X.NO_SKIP_SECONDS))
    out = rows.with_columns(
        {
            "skips_last_3m": skips_3m.cast("bigint"),
            "skips_last_15m": skips_15m.cast("bigint"),
            "seconds_since_last_skip": known,
            "mood": mood(skips_3m, known, F.col("progress_sec")),
            "previous_song_skipped": F.coalesce("_flag", F.lit(0)),
        }
    )
    return out.rows(
        ["user_id", "event_id", "skips_last_3m", "skips_last_15m", "seconds_since_last_skip", "mood", "previous_song_skipped"]
    )
