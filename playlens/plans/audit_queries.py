"""Replay, live polls, prediction audit and its metrics."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import audit, replay
from playlens.plans.enrich_queries import JOINED, LOOKUPS, lookups, with_new_names
from playlens.plans.oracle import rnd, with_views
from playlens.plans.registry import add
from playlens.session import scratch_path
from playlens.sources import readers

O = "(PARTITION BY user_id ORDER BY t, event_id)"
CUTOFF = "CASE WHEN {d} > 15 THEN greatest(10.0, {d} - 10.0) ELSE {short} END"


def clock_ctes(source):
    """Replay state as a listener's log would give it; session rows are then self-joined."""
    return dict(
        src=source,
        k=f"SELECT *, t - lag(t) OVER {O} AS gap, lag(t) OVER {O} AS pt FROM src",
        i="SELECT *, CAST(coalesce(gap > 600000000, true) AS INTEGER) AS idle FROM k",
    )


RECENT = "SELECT *, epoch_us(played_at) AS t, duration_sec AS dur FROM recent_plays"
INFERRED = dict(
    **clock_ctes(RECENT),
    oc="SELECT *, CAST(idle = 0 AND gap / 1000000 < " + CUTOFF.format(d="dur", short="dur") + " AS INTEGER) AS sk, "
    f"CASE WHEN idle = 1 THEN dur ELSE {rnd('least(gap / 1000000, dur)', 1)} END AS played FROM i",
)
STATE = dict(
    s=f"SELECT *, sum(idle) OVER {O} AS sid, row_number() OVER {O} AS ix, "
    "CASE WHEN idle = 1 THEN t - CAST(dur * 1000000 AS BIGINT) ELSE pt END AS st FROM oc",
    h="SELECT a.user_id, a.event_id, CAST(count(b.ix) FILTER (WHERE a.st - b.t <= 180000000) AS BIGINT) AS s3, "
    "CAST(count(b.ix) FILTER (WHERE a.st - b.t <= 900000000) AS BIGINT) AS s15, max(b.t) AS last_t, max(b.ix) AS last_ix "
    "FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND a.sid = b.sid AND b.ix < a.ix AND b.sk = 1 GROUP BY 1, 2",
    f0="SELECT user_id, sid, min(ix) AS first_ix FROM s GROUP BY 1, 2",
    z=f"SELECT s.*, h.s3, h.s15, CASE WHEN st - last_t <= 900000000 THEN (st - last_t) / 1000000 ELSE 10000.0 END AS since, "
    "CAST(coalesce(last_ix = ix - 1, false) AS INTEGER) AS prev, ix - 1 - coalesce(last_ix, first_ix - 1) AS streak "
    "FROM s JOIN h USING (user_id, event_id) JOIN f0 USING (user_id, sid)",
)
STATE_SELECT = (
    "x.user_id, x.event_id, x.s3 AS skips_last_3m, x.s15 AS skips_last_15m, "
    + rnd("x.since", 6)
    + " AS seconds_since_last_skip, x.prev AS previous_song_skipped, x.streak AS consecutive_listens_streak, "
    "CASE WHEN x.prev = 1 THEN 'fwdbtn' ELSE 'trackdone' END AS reason_start, "
    "CAST(x.idle = 1 OR x.streak = 0 AS INTEGER) AS is_session_start, "
    "CAST(hour(make_timestamp(x.st)) AS INTEGER) AS hour_of_day, CAST(isodow(make_timestamp(x.st)) - 1 AS INTEGER) AS day_of_week, "
    "CAST(al.lookup_key IS NULL AS INTEGER) AS is_cold_start_artist, "
    + rnd("coalesce(sl.rate, al.rate, 0.104)", 6)
    + " AS song_smoothed_skip_rate, "
    + ", ".join(f"{rnd('coalesce(al.rate, 0.104)', 6)} AS {n}_smoothed_skip_rate" for n in ("artist", "genre", "album"))
    + ", "
    + rnd("sin(2 * pi() * hour(make_timestamp(x.st)) / 24)", 6)
    + " AS hour_sin, "
    + rnd("cos(2 * pi() * hour(make_timestamp(x.st)) / 24)", 6)
    + " AS hour_cos, 0 AS platform_android, 1 AS platform_windows, 0 AS shuffle_mode, "
    "CAST(CASE WHEN x.prev = 1 THEN 0.604 ELSE 0.025 END AS DOUBLE) AS reason_start_smoothed_skip_rate, x.sk AS actual_skipped"
)

def state_columns():
    return [
        "user_id", "event_id", "skips_last_3m", "skips_last_15m",
        X.round_even("seconds_since_last_skip", 6).alias("seconds_since_last_skip"),
        "previous_song_skipped", "consecutive_listens_streak", "reason_start", "is_session_start", "hour_of_day",
        "day_of_week", "is_cold_start_artist", X.round_even("song_smoothed_skip_rate", 6).alias("song_smoothed_skip_rate"),
        *[X.round_even(c, 6).alias(c) for c in ("artist_smoothed_skip_rate", "genre_smoothed_skip_rate", "album_smoothed_skip_rate", "hour_sin", "hour_cos")],
        "platform_android", "platform_windows", "shuffle_mode", "reason_start_smoothed_skip_rate", "actual_skipped",
    ]


add(
    "infer_outcome",
    lambda t: replay.infer_outcome(t.recent_plays),
    with_views(
        "recent_plays",
        "SELECT user_id, event_id, idle AS is_idle_break, sk AS actual_skipped, played AS actual_played_sec FROM oc",
        **INFERRED,
    ),
)
add(
    "session_replay_features",
    lambda t: replay.session_replay_features(with_new_names(t.recent_plays), *lookups(t)).select(*state_columns()),
    with_views("recent_plays", f"SELECT {STATE_SELECT} FROM z x {JOINED}", **LOOKUPS, **INFERRED, **STATE),
)


def audit_log(t):
    """Resolved plays with known outcomes; a tenth have no recorded duration."""
    known = F.when(F.col("event_id") % 10 != 3, F.col("duration_sec"))
    return t.recent_plays.join(t.plays.select("event_id", "skipped"), "event_id").select(
        "user_id", "event_id", "played_at", "song_name", "artist_name",
        known.alias("total_duration_sec"), F.col("skipped").alias("actual_skipped"),
    )


AUDIT_LOG = dict(
    **clock_ctes(
        "SELECT r.user_id, r.event_id, r.song_name, r.artist_name, epoch_us(r.played_at) AS t, "
        "CASE WHEN r.event_id % 10 <> 3 THEN duration_sec ELSE 180.0::DOUBLE END AS dur, p.skipped AS sk0 "
        "FROM recent_plays r JOIN plays p USING (event_id)"
    ),
    oc="SELECT *, sk0 AS sk FROM i",
)
add(
    "audit_training_features",
    lambda t: replay.audit_training_features(with_new_names(audit_log(t)), *lookups(t)).select(*state_columns()),
    with_views("recent_plays", f"SELECT {STATE_SELECT} FROM z x {JOINED}", **LOOKUPS, **AUDIT_LOG, **STATE),
)
PROB = "(event_id * 37 % 1000) / 1000"
add(
    "grade_predictions",
    lambda t: replay.grade(replay.decide(replay.infer_outcome(t.recent_plays).withColumn("predicted_prob", F.col("event_id") * 37 % 1000 / 1000)))
    .select("event_id", "predicted_skip", "risk_tier", "evaluation_result", "cdn_mb_saved"),
    with_views(
        "recent_plays",
        "SELECT event_id, ps AS predicted_skip, CASE WHEN ps = 1 THEN 'CRITICAL' WHEN pr < 0.35 THEN 'LOW' ELSE 'MODERATE' END AS risk_tier, "
        "CASE WHEN ps = 1 AND sk = 1 THEN 'TRUE_POSITIVE' WHEN ps = 0 AND sk = 0 THEN 'TRUE_NEGATIVE' WHEN ps = 1 THEN 'FALSE_POSITIVE' "
        "ELSE 'FALSE_NEGATIVE' END AS evaluation_result, "
        "CASE WHEN ps = 1 AND sk = 1 AND played < 45 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cdn_mb_saved "
        f"FROM (SELECT *, {PROB} AS pr, CAST({PROB} >= 0.45 AS INTEGER) AS ps FROM oc)",
        **INFERRED,
    ),
)

# --- live polls -----------------------------------------------------------------------------------
POLL = dict(
    a="SELECT *, epoch_us(poll_ts) AS t FROM progress WHERE status = 'ACTIVE'",
    b=f"SELECT *, lag(track_id) OVER {O} AS lt, lag(progress_sec) OVER {O} AS lp, lag(duration_sec) OVER {O} AS ld FROM a",
    c="SELECT *, CAST(lt IS NULL OR track_id <> lt OR progress_sec < lp - 5 AS INTEGER) AS ch FROM b",
    d="SELECT *, CAST(ch = 1 AND lt IS NOT NULL AND lp < " + CUTOFF.format(d="ld", short="30.0") + " AS INTEGER) AS sk, "
    f"row_number() OVER {O} AS ix FROM c",
)
add(
    "track_change_detect",
    lambda t: replay.closed_plays(t.progress),
    with_views(
        "progress",
        "SELECT user_id, event_id, lt AS track_id, lp AS listen_sec, ld AS total_sec, sk AS was_skipped FROM d WHERE ch = 1 AND lt IS NOT NULL",
        **POLL,
    ),
)
MOOD = dict(
    **POLL,
    e="SELECT a.user_id, a.event_id, a.t, a.progress_sec, a.ix, CAST(count(b.ix) FILTER (WHERE a.t - b.t <= 180000000) AS BIGINT) AS s3, "
    "CAST(count(b.ix) FILTER (WHERE a.t - b.t <= 900000000) AS BIGINT) AS s15, max(b.t) AS lt FROM d a "
    "LEFT JOIN d b ON a.user_id = b.user_id AND b.ix <= a.ix AND b.sk = 1 GROUP BY ALL",
    g="SELECT *, CASE WHEN t - lt <= 900000000 THEN (t - lt) / 1000000 ELSE 10000.0 END AS since FROM e",
    w="SELECT a.user_id, a.event_id, arg_max(CASE WHEN b.ch = 1 THEN b.sk ELSE 0 END, b.ix) AS flag FROM d a "
    "JOIN d b ON a.user_id = b.user_id AND b.ix <= a.ix AND (b.ch = 1 OR b.progress_sec >= 45) GROUP BY 1, 2",
)
add(
    "session_mood",
    lambda t: replay.session_mood(t.progress).withColumn("seconds_since_last_skip", X.round_even("seconds_since_last_skip", 6)),
    with_views(
        "progress",
        f"SELECT user_id, event_id, s3 AS skips_last_3m, s15 AS skips_last_15m, {rnd('since', 6)} AS seconds_since_last_skip, "
        "CASE WHEN s3 >= 2 AND progress_sec < 45 THEN 'SKIP_SPREE' WHEN (s3 >= 1 OR since < 45) AND progress_sec < 60 THEN 'RESTLESS' "
        "ELSE 'CALM_FLOW' END AS mood, coalesce(flag, 0) AS previous_song_skipped FROM g LEFT JOIN w USING (user_id, event_id)",
        **MOOD,
    ),
)

# --- pending and resolved predictions ---------------------------------------------------------------
LOGGED = dict(
    lp="SELECT *, CAST(flagged = 1 OR prob >= 0.45 AS INTEGER) AS ps, CASE WHEN prob >= 0.45 THEN 'CRITICAL' WHEN prob < 0.35 THEN 'LOW' "
    "ELSE 'MODERATE' END AS tier FROM predictions"
)
KEY = "user_id, song_name, artist_name"
SAME = "o.user_id = p.user_id AND o.song_name = p.song_name AND o.artist_name = p.artist_name"
add(
    "pending_upsert",
    lambda t: audit.pending_predictions(t.predictions, t.outcomes),
    with_views(
        "predictions outcomes",
        f"SELECT {KEY}, event_id AS prediction_id, made_at AS predicted_at, prob AS predicted_prob, ps AS predicted_skip, tier AS risk_tier, "
        f"'PENDING' AS status FROM lp p WHERE NOT EXISTS (SELECT 1 FROM outcomes o WHERE {SAME} AND (o.made_at, o.event_id) > (p.made_at, p.event_id)) "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY made_at DESC, event_id DESC) = 1",
        **LOGGED,
    ),
)
RESOLVED = dict(
    **LOGGED,
    pv=f"SELECT *, lag(made_at) OVER (PARTITION BY {KEY} ORDER BY made_at, event_id) AS pat, lag(event_id) OVER (PARTITION BY {KEY} ORDER BY made_at, event_id) AS pid FROM outcomes",
    jn=f"SELECT o.user_id, o.song_name, o.artist_name, o.event_id, arg_max((prob, ps, tier), (p.made_at, p.event_id)) AS best FROM pv o "
    f"JOIN lp p ON {SAME} AND (p.made_at, p.event_id) < (o.made_at, o.event_id) AND (o.pat IS NULL OR (p.made_at, p.event_id) > (o.pat, o.pid)) GROUP BY 1, 2, 3, 4",
    rz="SELECT o.user_id, o.song_name, o.artist_name, o.event_id AS outcome_id, o.made_at AS resolved_at, "
    "CAST(coalesce(best[1], 0.35) AS DOUBLE) AS predicted_prob, coalesce(best[2], 0) AS predicted_skip, coalesce(best[3], 'UNKNOWN') AS risk_tier, "
    f"{rnd('listen_sec', 1)} AS actual_played_sec, {rnd('total_sec', 1)} AS total_duration_sec, was_skipped AS actual_skipped "
    "FROM outcomes o LEFT JOIN jn USING (user_id, song_name, artist_name, event_id)",
    gr="SELECT *, CASE WHEN predicted_skip = 1 AND actual_skipped = 1 THEN 'TRUE_POSITIVE' WHEN predicted_skip = 0 AND actual_skipped = 0 THEN 'TRUE_NEGATIVE' "
    "WHEN predicted_skip = 1 THEN 'FALSE_POSITIVE' ELSE 'FALSE_NEGATIVE' END AS evaluation_result, "
    "CASE WHEN predicted_skip = 1 AND actual_skipped = 1 AND actual_played_sec < 45 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cdn_mb_saved, "
    "'RESOLVED' AS status FROM rz",
)
add(
    "resolve_outcomes",
    lambda t: audit.resolve_outcomes(t.predictions, t.outcomes),
    with_views("predictions outcomes", "SELECT * FROM gr", **RESOLVED),
)


def metrics_sql(source, views, **ctes):
    return with_views(
        views,
        f"SELECT n AS total_evaluated, tp, tn, fp, fn, {rnd('mb', 2)} AS mb_saved, "
        f"{rnd('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) * 100 ELSE 0 END', 1)} AS precision, "
        f"{rnd('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) * 100 ELSE 0 END', 1)} AS recall, "
        f"{rnd('CASE WHEN n > 0 THEN (tp + tn) / n * 100 ELSE 0 END', 1)} AS accuracy FROM "
        "(SELECT count(*) AS n, "
        + ", ".join(
            f"count(*) FILTER (WHERE evaluation_result = '{v}') AS {k}"
            for k, v in {"tp": "TRUE_POSITIVE", "tn": "TRUE_NEGATIVE", "fp": "FALSE_POSITIVE", "fn": "FALSE_NEGATIVE"}.items()
        )
        + f", coalesce(sum(cdn_mb_saved), 0) AS mb FROM {source} WHERE status = 'RESOLVED')",
        **ctes,
    )


add("audit_metrics", lambda t: audit.audit_metrics(t.audit), metrics_sql("audit", "audit"))
add(
    "audit_metrics_resolved",
    lambda t: audit.audit_metrics(audit.resolve_outcomes(t.predictions, t.outcomes)),
    metrics_sql("gr", "predictions outcomes", **RESOLVED),
)
RECENT_COLUMNS = ["event_id", "played_at", "song_name", "predicted_prob", "actual_played_sec", "evaluation_result", "cdn_mb_saved"]
add(
    "audit_recent",
    lambda t: audit.recent_resolved(t.audit).select(*RECENT_COLUMNS),
    with_views("audit", f"SELECT {', '.join(RECENT_COLUMNS)} FROM audit WHERE status = 'RESOLVED' ORDER BY played_at DESC, event_id DESC LIMIT 10"),
)
add(
    "resolved_count",
    lambda t: audit.resolved_count(t.audit),
    with_views("audit", "SELECT count(*) FILTER (WHERE status = 'RESOLVED' OR actual_skipped IS NOT NULL) AS resolved FROM audit"),
)
add(
    "sink_jsonl_append_dedup",
    lambda t: audit.append_counts(t.audit, t.audit.where("evaluation_result = 'TRUE_NEGATIVE'"), ["user_id", "played_at"]),
    with_views(
        "audit",
        "SELECT i AS inserted, (SELECT count(*) FROM audit) - i AS duplicates FROM (SELECT count(*) AS i FROM "
        "(SELECT DISTINCT user_id, played_at FROM audit EXCEPT SELECT user_id, played_at FROM audit WHERE evaluation_result = 'TRUE_NEGATIVE'))",
    ),
)
add(
    "audit_schema_evolve",
    lambda t: audit.evolve(
        t.audit.where("status = 'PENDING'").select("event_id", "song_name", "status"),
        t.audit.where("status = 'RESOLVED'").select("event_id", "song_name", "status", "played_at", F.lit("x").alias("album_name")),
    ),
    with_views(
        "audit",
        "SELECT event_id, song_name, status, CASE WHEN status = 'RESOLVED' THEN played_at END AS played_at, "
        "CASE WHEN status = 'RESOLVED' THEN 'x' END AS album_name FROM audit",
    ),
)


def generations(t):
    """Three generations of the audit table: the second has more columns and lacks one, the third has wider ones."""
    a, path = t.audit, scratch_path(t.spark, "audit-generations")
    parts = [
        a.where("event_id % 3 = 0").select(F.col("event_id").cast("int").alias("event_id"), "song_name", F.col("predicted_prob").cast("float").alias("predicted_prob"), "status"),
        a.where("event_id % 3 = 1").select(F.col("event_id").cast("int").alias("event_id"), F.col("predicted_prob").cast("float").alias("predicted_prob"), "status", "played_at"),
        a.where("event_id % 3 = 2").select("event_id", "song_name", "predicted_prob", "status", "played_at", "cdn_mb_saved"),
    ]
    for i, part in enumerate(parts):
        part.write.parquet(f"{path}/{i}")
    out = readers.read_generations(t.spark, *[f"{path}/{i}" for i in range(3)])
    return out.withColumn("predicted_prob", X.round_even("predicted_prob", 4))


add(
    "audit_read_generations",
    generations,
    with_views(
        "audit",
        f"SELECT event_id, CASE WHEN event_id % 3 <> 1 THEN song_name END AS song_name, {rnd('predicted_prob', 4)} AS predicted_prob, status, "
        "CASE WHEN event_id % 3 > 0 THEN played_at END AS played_at, CASE WHEN event_id % 3 = 2 THEN cdn_mb_saved END AS cdn_mb_saved FROM audit",
    ),
)
