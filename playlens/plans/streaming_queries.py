"""Structured Streaming jobs over the event table, drained into files and read back."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import audit
from playlens.plans.audit_queries import INFERRED, JOINED, LOOKUPS, MOOD, RESOLVED, STATE, STATE_SELECT, lookups, metrics_sql, state_columns
from playlens.plans.enrich_queries import with_new_names
from playlens.plans.oracle import rnd, with_views
from playlens.plans.registry import add
from playlens.session import scratch_path
from playlens.sources import schemas
from playlens.sources.tables import Tables
from playlens.streaming import ingest, run, stateful, windows


class StreamTables(Tables):
    """The canonical views with ``events`` read as a stream."""

    def table(self, name):
        static = super().table(name)
        if name != "events":
            return static
        return run.read_stream(self.spark, self.sf_dir, static.schema, pathGlobFilter="events.parquet")


def streamed(t):
    return StreamTables(t.spark, t.sf_dir)


# --- polls ------------------------------------------------------------------------------------------
def polls(t):
    """Overlapping polls: every event is reported by two of them, some fields are missing. A poll covers
    50 consecutive events, so its list is short."""
    e = t.table("events").withColumn("k", F.get_json_object("props", "$.k"))
    i = F.col("event_id")
    track = F.struct(
        F.when(i % 4 != 0, F.col("k")).alias("id"),
        F.concat(F.lit("s"), "k").alias("name"),
        F.when(i % 5 != 0, (F.col("value") * 1000).cast("bigint")).alias("duration_ms"),
        F.when(i % 6 != 0, F.array(F.struct(F.concat(F.lit("a"), "k").alias("name")))).alias("artists"),
        F.struct(F.when(i % 3 != 0, F.lit("album")).alias("name")).alias("album"),
    )
    played = F.when(i % 17 != 0, F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    block = F.floor(i / 50)
    reported = e.select("user_id", F.explode(F.array(block, block + 1)).alias("poll"), F.struct(played.alias("played_at"), track.alias("track")).alias("item"))
    return reported.groupBy("poll", "user_id").agg(F.collect_list("item").alias("items")).drop("poll")


def poll_stream(t, **options):
    path = scratch_path(t.spark, "polls")
    polls(t).write.json(path)
    return run.read_stream(t.spark, path, schemas.RECENT_POLL, "json", **options)


POLL_COLUMNS = ["user_id", "played_at", "track_id", "song_name", "artist_name", "album_name", "duration_sec"]
REPORTED = dict(
    e="SELECT user_id, event_id, date_trunc('millisecond', ts) AS played_at, json_extract_string(props, '$.k') AS k, value FROM events WHERE event_id % 17 <> 0",
    f="SELECT user_id, played_at, 's' || k AS song_name, CASE WHEN event_id % 6 <> 0 THEN 'a' || k ELSE 'Unknown Artist' END AS artist_name, "
    "CASE WHEN event_id % 3 <> 0 THEN 'album' ELSE 'Unknown Album' END AS album_name, CASE WHEN event_id % 4 <> 0 THEN k END AS id, "
    f"{rnd('CASE WHEN event_id % 5 <> 0 THEN trunc(value * 1000) ELSE 180000 END / 1000', 1)} AS duration_sec FROM e",
    g="SELECT user_id, played_at, coalesce(id, song_name || '::' || artist_name) AS track_id, song_name, artist_name, album_name, duration_sec FROM f",
)
add(
    "stream_ingest_recent",
    lambda t: run.collect_stream(ingest.flatten_polls(poll_stream(t)).select(*POLL_COLUMNS), "ingest").drop(run.BATCH),
    with_views("", "SELECT * FROM g UNION ALL SELECT * FROM g", **REPORTED),
)
add(
    "batch_ingest_recent",
    lambda t: ingest.flatten_polls(polls(t)).select(*POLL_COLUMNS),
    with_views("", "SELECT * FROM g UNION ALL SELECT * FROM g", **REPORTED),
)
add(
    "stream_dedup",
    lambda t: run.collect_stream(ingest.dedup_stream(ingest.flatten_polls(poll_stream(t))), "dedup").select("user_id", "played_at"),
    with_views("", "SELECT DISTINCT user_id, played_at FROM g", **REPORTED),
)
add(
    "stream_idempotent_sink",
    lambda t: run.collect_stream(
        ingest.flatten_polls(poll_stream(t, maxFilesPerTrigger=2)), "once", sink_keys=["user_id", "played_at"], time="played_at"
    ).select("user_id", "played_at"),
    with_views("", "SELECT DISTINCT user_id, played_at FROM g", **REPORTED),
)


def late_data(t):
    """Three deliveries into one folder; the third brings errors of earlier days. Those inside the 8-day
    look-back are merged, older ones ignored."""
    source, out, checkpoint = (scratch_path(t.spark, n) for n in ("late", "late-out", "late-checkpoint"))
    e = t.table("events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("played_at"))
    day = F.to_date("played_at")
    held = (F.col("event_type") == "error") & (day >= "2024-01-05") & (day < "2024-01-15")
    first, second = day < "2024-01-11", (day >= "2024-01-11") & (day < "2024-01-21")
    for delivery in (e.where(first & ~held), e.where(second & ~held), e.where((day >= "2024-01-21") | held)):
        delivery.write.mode("append").parquet(source)
        stream = run.read_stream(t.spark, source, e.schema)
        run.drain(ingest.dedup_stream(stream, "8 days", ["user_id", "event_id"]), out, checkpoint)
    return t.spark.read.parquet(out).select("user_id", "event_id")


add(
    "late_data_policy",
    late_data,
    "WITH w AS (SELECT epoch_ms(max(ts)) - 8 * 86400000 AS ms FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-21' "
    "AND NOT (event_type = 'error' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14')) "
    "SELECT user_id, event_id FROM events, w WHERE NOT (event_type = 'error' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' "
    "AND epoch_us(ts) <= ms * 1000)",
)

# --- windows ----------------------------------------------------------------------------------------
MARK = "SELECT (epoch_ms(max(time_stamp)) - 600000) * 1000 AS us FROM plays"
add(
    "stream_sessions",
    lambda t: run.collect_stream(windows.sessions(streamed(t).plays), "sessions").drop(run.BATCH),
    with_views(
        "plays",
        "SELECT user_id, min(time_stamp) AS session_start, max(time_stamp) AS last_play, count(*) AS songs, CAST(sum(sec_played) AS BIGINT) AS total_sec "
        "FROM s, m GROUP BY user_id, sid, us HAVING epoch_us(max(time_stamp)) + 1800000000 <= us",
        m=MARK,
        l="SELECT *, CAST(coalesce(epoch_us(time_stamp) - epoch_us(lag(time_stamp) OVER (PARTITION BY user_id ORDER BY time_stamp, event_id)) > 1800000000, true) AS INTEGER) AS new FROM plays",
        s="SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY time_stamp, event_id) AS sid FROM l",
    ),
)
add(
    "stream_tumbling_volume",
    lambda t: run.collect_stream(windows.tumbling_volume(streamed(t).plays), "tumbling").drop(run.BATCH),
    with_views(
        "plays",
        "SELECT date_trunc('hour', time_stamp) AS window_start, count(*) AS plays, CAST(sum(sec_played) AS BIGINT) AS seconds, CAST(sum(skipped) AS BIGINT) AS skips "
        "FROM plays, m GROUP BY 1, us HAVING epoch_us(date_trunc('hour', time_stamp)) + 3600000000 <= us",
        m=MARK,
    ),
)
add(
    "stream_sliding_skips",
    lambda t: run.collect_stream(windows.sliding_skips(streamed(t).plays), "sliding").drop(run.BATCH),
    with_views(
        "plays",
        "SELECT user_id, make_timestamp(w) AS window_start, count(*) AS plays, CAST(sum(skipped) AS BIGINT) AS skips FROM x, m GROUP BY 1, w, us "
        "HAVING w + 900000000 <= us",
        m=MARK,
        x="SELECT user_id, skipped, unnest([epoch_us(time_stamp) // 180000000 * 180000000 - k * 180000000 for k in [0, 1, 2, 3, 4]]) AS w FROM plays",
    ),
)
add(
    "stream_audit_metrics",
    lambda t: run.last_batch(run.collect_stream(windows.running_audit_metrics(streamed(t).audit), "metrics", "complete")),
    metrics_sql("audit", "audit"),
)

# --- state per listener -------------------------------------------------------------------------------
def delivered(t, frames, time, job, deliveries=3, late=0):
    """Each frame arrives in several deliveries by time, each drained by the job from one checkpoint. Every ``late``-th row comes one
    delivery after its time. A last delivery holds a heartbeat a year on, which moves the watermark past all rows."""
    sources = [scratch_path(t.spark, "deliveries") for _ in frames]
    out, checkpoint = scratch_path(t.spark, "delivered"), scratch_path(t.spark, "deliveries-checkpoint")
    at = X.micros(time)
    ends = [f.agg(F.min(at), F.max(at)).first() for f in frames]
    lo, hi = min(e[0] for e in ends), max(e[1] for e in ends)
    part = F.least(F.floor((at - lo) * deliveries / (hi - lo + 1)), F.lit(deliveries - 1))
    if late:
        part = F.least(part + (F.col("event_id") % late == 0).cast("int"), F.lit(deliveries - 1))
    for i in range(deliveries + 1):
        for frame, source in zip(frames, sources):
            beat = [F.timestamp_micros(F.lit(hi + 366 * 86400 * 1000000)).alias(c) if c == time else F.lit(None).cast(frame.schema[c].dataType).alias(c) for c in frame.columns]
            rows = frame.where(part == i) if i < deliveries else t.spark.range(1).select(*beat)
            rows.write.mode("append").parquet(source)
        run.drain(job(*[run.read_stream(t.spark, s, f.schema) for f, s in zip(frames, sources)]), out, checkpoint)
    return t.spark.read.parquet(out).drop(run.BATCH)


SINCE = rnd("since", 6)


def replay_stream(t):
    recent = with_new_names(t.recent_plays).select("user_id", "event_id", "played_at", "duration_sec", "song_name", "artist_name")
    rates = lookups(t)
    told = delivered(t, [recent], "played_at", lambda s: stateful.session_replay(s, *rates))
    return told.select(*state_columns(), "actual_played_sec")


add(
    "stream_session_replay",
    replay_stream,
    with_views("recent_plays", f"SELECT {STATE_SELECT}, x.played AS actual_played_sec FROM z x {JOINED}", **LOOKUPS, **INFERRED, **STATE),
)


def resolve_stream(t, late=0, delay_sec=600):
    return delivered(t, [t.predictions, t.outcomes], "made_at", lambda p, o: stateful.resolve(p, o, delay_sec, None), late=late)


RESOLVED_COLUMNS = [
    "user_id", "outcome_id", "song_name", "artist_name", "predicted_prob", "predicted_skip", "risk_tier", "actual_played_sec", "actual_skipped", "evaluation_result", "cdn_mb_saved",
]
RESOLVED_SQL = with_views("predictions outcomes", f"SELECT {', '.join(RESOLVED_COLUMNS)} FROM gr", **RESOLVED)
add("stream_resolve_outcomes", lambda t: resolve_stream(t).select(*RESOLVED_COLUMNS), RESOLVED_SQL)
#: A third of the rows come a delivery late, within the watermark.
add("stream_resolve_late", lambda t: resolve_stream(t, 3, 40 * 86400).select(*RESOLVED_COLUMNS), RESOLVED_SQL)
add(
    "stream_mood",
    lambda t: delivered(t, [t.progress], "poll_ts", stateful.mood).withColumn("seconds_since_last_skip", X.round_even("seconds_since_last_skip", 6)),
    with_views(
        "progress",
        f"SELECT user_id, event_id, s3 AS skips_last_3m, s15 AS skips_last_15m, {SINCE} AS seconds_since_last_skip, "
        "CASE WHEN s3 >= 2 AND progress_sec < 45 THEN 'SKIP_SPREE' WHEN (s3 >= 1 OR since < 45) AND progress_sec < 60 THEN 'RESTLESS' "
        "ELSE 'CALM_FLOW' END AS mood, coalesce(flag, 0) AS previous_song_skipped FROM g LEFT JOIN w USING (user_id, event_id)",
        **MOOD,
    ),
)
add(
    "stream_resolved_metrics",
    lambda t: audit.audit_metrics(resolve_stream(t)),
    metrics_sql("gr", "predictions outcomes", **RESOLVED),
)
