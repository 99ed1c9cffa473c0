"""Splits, curves, thresholds, policies, gates, batch decisions and model training."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import evaluate, features, models, policy, queue, splits
from playlens.plans.enrich_queries import LOOKUPS, lookups
from playlens.plans.feature_queries import matrix_sql, skipped_view
from playlens.plans.oracle import rnd, with_views
from playlens.plans.registry import add

SIX = 6


def rounded(df, *columns, digits=SIX):
    return df.withColumns({c: X.round_even(c, digits) for c in columns})


# --- splits -----------------------------------------------------------------------------------------
add(
    "temporal_split_year",
    lambda t: splits.by_year(t.plays_long, 1996, 1999).select("event_id", "split"),
    with_views("plays_long", "SELECT event_id, CASE WHEN year(time_stamp) <= 1999 THEN 'train' ELSE 'test' END AS split FROM plays_long WHERE year(time_stamp) >= 1996"),
)
RANKED = "SELECT event_id, row_number() OVER (ORDER BY time_stamp, event_id) AS r, count(*) OVER () AS n FROM {0}"
for name, view, fraction in (
    ("temporal_split_fraction_70", "plays", 0.7),
    ("temporal_split_fraction_80", "plays_long", 0.8),
    ("temporal_split_fraction_95", "plays_long", 0.95),
):
    add(
        name,
        lambda t, v=view, f=fraction: splits.by_fraction(getattr(t, v), f).select("event_id", "split"),
        with_views(view, f"SELECT event_id, CASE WHEN r <= trunc(n * {fraction}::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM ({RANKED.format(view)})"),
    )
add(
    "temporal_split_tail",
    lambda t: splits.tail(t.plays_long).select("event_id", "split"),
    with_views("plays_long", f"SELECT event_id, CASE WHEN r <= n - greatest(500, trunc(n * 0.15::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM ({RANKED.format('plays_long')})"),
)
add(
    "order_positions",
    lambda t: splits.order_positions(t.plays.select("event_id", "time_stamp")).select("event_id", "position"),
    with_views("plays", f"SELECT event_id, r AS position FROM ({RANKED.format('plays')})"),
)
SHARED = ["event_id", "skipped", "reason_start", "sec_played"]
add(
    "union_training_frames",
    lambda t: splits.assemble([t.plays_long, t.plays.drop("sec_played").withColumn("sec_played", F.lit(1))], SHARED),
    with_views(
        "plays plays_long",
        "SELECT event_id, skipped, reason_start, sec_played FROM plays_long WHERE reason_start IS NOT NULL "
        "UNION ALL SELECT event_id, skipped, reason_start, 1 FROM plays WHERE reason_start IS NOT NULL",
    ),
)
add(
    "training_set_assembly",
    lambda t: splits.assemble([t.plays_long, t.plays], [*SHARED, "album_name"]).groupBy("reason_start").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("skipped").alias("skips")
    ),
    with_views(
        "plays plays_long",
        "SELECT reason_start, count(*) AS rows, CAST(sum(skipped) AS BIGINT) AS skips FROM (SELECT reason_start, skipped, album_name FROM plays "
        "UNION ALL SELECT reason_start, skipped, album_name FROM plays_long) WHERE reason_start IS NOT NULL AND album_name IS NOT NULL GROUP BY 1",
    ),
)
add(
    "class_weight",
    lambda t: rounded(splits.class_weights(t.plays, "skipped"), "scale_pos_weight"),
    with_views(
        "plays",
        f"SELECT p AS positives, n AS negatives, {rnd('n / greatest(p, 1)', SIX)} AS scale_pos_weight FROM "
        "(SELECT count(*) FILTER (WHERE skipped = 1) AS p, count(*) FILTER (WHERE skipped = 0) AS n FROM plays)",
    ),
)

# --- curves -----------------------------------------------------------------------------------------
CURVE = dict(
    c="SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored_long GROUP BY 1, 2",
    u="SELECT *, CAST(sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS BIGINT) AS tp, "
    "CAST(sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS BIGINT) AS fp, sum(pos) OVER (PARTITION BY model) AS p, "
    "sum(neg) OVER (PARTITION BY model) AS n FROM c",
    v="SELECT model, score AS threshold, tp, fp, tp / (tp + fp) AS precision, tp / p AS recall FROM u",
)
add(
    "pr_curve",
    lambda t: rounded(evaluate.pr_curve(t.scored_long()), "precision", "recall"),
    with_views("scored_long", f"SELECT model, threshold, tp, fp, {rnd('precision', SIX)} AS precision, {rnd('recall', SIX)} AS recall FROM v", **CURVE),
)
BEST = "SELECT model, threshold, {p} AS precision, {r} AS recall, {x} FROM g QUALIFY row_number() OVER (PARTITION BY model ORDER BY {o}, threshold) = 1"
P6, R6 = rnd("precision", SIX), rnd("recall", SIX)
add(
    "threshold_f1",
    lambda t: rounded(evaluate.threshold_f1(t.scored_long()), "precision", "recall", "f1"),
    with_views(
        "scored_long", BEST.format(p=P6, r=R6, x=rnd("f", SIX) + " AS f1", o="f DESC"),
        **CURVE, g="SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f FROM v",
    ),
)
for name, floor in (("threshold_precision_floor", 0.80), ("threshold_precision_floor_fallback", 1.1)):
    add(
        name,
        lambda t, fl=floor: rounded(evaluate.threshold_precision_floor(t.scored_long(), fl), "precision", "recall"),
        with_views(
            "scored_long",
            BEST.format(p=P6, r=R6, x=f"CAST(precision >= {floor} AS INTEGER) AS meets_floor", o=f"precision >= {floor} DESC, m DESC"),
            **CURVE,
            g=f"SELECT *, CASE WHEN precision >= {floor} THEN recall ELSE 2 * precision * recall / greatest(precision + recall, 1e-9) END AS m FROM v",
        ),
    )
AUC = dict(
    **CURVE,
    auc="SELECT model, CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives, "
    "sum((tp - pos + pos / 2) * neg) / (CAST(max(p) AS DOUBLE) * max(n)) AS area FROM u GROUP BY 1",
)
add(
    "roc_auc",
    lambda t: rounded(evaluate.roc_auc(t.scored_long()), "roc_auc"),
    with_views("scored_long", f"SELECT model, positives, negatives, {rnd('area', SIX)} AS roc_auc FROM auc", **AUC),
)


def ratio(a, b):
    return f"CASE WHEN {b} > 0 THEN ({a}) / ({b}) ELSE 0 END"


def counts(threshold, source="scored_long"):
    return (
        f"SELECT model, count(*) FILTER (WHERE score >= {threshold} AND label = 1) AS tp, count(*) FILTER (WHERE score < {threshold} AND label = 0) AS tn, "
        f"count(*) FILTER (WHERE score >= {threshold} AND label = 0) AS fp, count(*) FILTER (WHERE score < {threshold} AND label = 1) AS fn "
        f"FROM {source} GROUP BY 1"
    )


def report_line(label, hit, false_call, miss):
    return (
        f"SELECT model, {label} AS label, {ratio(hit, f'{hit} + {false_call}')} AS pr, {ratio(hit, f'{hit} + {miss}')} AS re, "
        f"{hit} + {miss} AS support, (tp + tn) / (tp + tn + fp + fn) AS accuracy FROM k"
    )


REPORT = dict(k=counts(0.5), rp=report_line(0, "tn", "fn", "fp") + " UNION ALL " + report_line(1, "tp", "fp", "fn"))
add(
    "confusion_report",
    lambda t: rounded(evaluate.confusion_report(t.scored_long(), 0.5), "precision", "recall", "f1", "accuracy"),
    with_views(
        "scored_long",
        f"SELECT model, label, {rnd('pr', SIX)} AS precision, {rnd('re', SIX)} AS recall, {rnd(ratio('2 * pr * re', 'pr + re'), SIX)} AS f1, support, "
        f"{rnd('accuracy', SIX)} AS accuracy FROM rp",
        **REPORT,
    ),
)
add(
    "confusion_crosstab",
    lambda t: evaluate.confusion(t.scored_long(), 0.749),
    with_views("scored_long", counts(0.749)),
)
add(
    "model_metrics",
    lambda t: rounded(models.model_metrics(t.scored_long(), 0.5, "holdout"), "roc_auc", "precision", "recall", "f1"),
    with_views(
        "scored_long",
        f"SELECT model, 'holdout' AS split, {rnd('area', SIX)} AS roc_auc, {rnd('pr', SIX)} AS precision, {rnd('re', SIX)} AS recall, "
        f"{rnd(ratio('2 * pr * re', 'pr + re'), SIX)} AS f1, 0.5::DOUBLE AS threshold, positives + negatives AS records FROM rp JOIN auc USING (model) WHERE label = 1",
        **AUC, **REPORT,
    ),
)
add(
    "soft_vote",
    lambda t: rounded(evaluate.soft_vote(t.scored, ["champion", "high_recall"]).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.rint(F.col("score") * 2000).cast("bigint")).alias("score_sum")
    )),
    with_views("scored", "SELECT label, count(*) AS rows, CAST(sum(CAST(round_even((champion + high_recall) * 1000, 0) AS BIGINT)) AS BIGINT) AS score_sum FROM scored GROUP BY 1"),
)


def score_tables(t):
    e = t.table("events")
    one = e.select("user_id", "event_id", (F.col("event_id") * 37 % 1000 / 1000).alias("score"))
    two = e.select("user_id", "event_id", (F.col("event_id") * 91 % 1000 / 1000).alias("score"))
    return [one, two]


add(
    "soft_vote_tables",
    lambda t: rounded(evaluate.soft_vote_tables(score_tables(t), ["user_id", "event_id"]), "score"),
    f"SELECT user_id, event_id, {rnd('(event_id * 37 % 1000 / 1000 + event_id * 91 % 1000 / 1000) / 2', SIX)} AS score, 2::BIGINT AS models FROM events",
)

# --- policies ---------------------------------------------------------------------------------------
MONEY = ["precision", "recall", "f1", "mb_saved", "gb_saved", "cdn_savings_usd", "ux_penalty_usd", "net_utility_usd"]
NINE = 9


def utility_sql():
    p, r = ratio("tp", "tp + fp"), ratio("tp", "tp + fn")
    usd = "tp * 1.0::DOUBLE / 1024 * 0.08::DOUBLE"
    parts = {
        "precision": p,
        "recall": r,
        "f1": ratio(f"2 * ({p}) * ({r})", f"({p}) + ({r})"),
        "mb_saved": "tp * 1.0::DOUBLE",
        "gb_saved": "tp * 1.0::DOUBLE / 1024",
        "cdn_savings_usd": usd,
        "ux_penalty_usd": "fp * 0.05::DOUBLE",
        "net_utility_usd": f"{usd} - fp * 0.05::DOUBLE",
    }
    return ", ".join(f"{rnd(x, SIX)} AS {c}" for c, x in parts.items())


add(
    "policy_utility",
    lambda t: rounded(policy.policy_utility(t.scored_long(), 0.749), *MONEY),
    with_views("scored_long", f"SELECT model, tp, tn, fp, fn, 0.749::DOUBLE AS threshold, {utility_sql()} FROM k", k=counts(0.749)),
)
GRID = ", ".join(f"({x}::DOUBLE)" for x in policy.SWEEP)
SWEEP = dict(
    k="SELECT model, threshold, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp, count(*) FILTER (WHERE score < threshold AND label = 0) AS tn, "
    "count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp, count(*) FILTER (WHERE score < threshold AND label = 1) AS fn "
    f"FROM scored_long, (VALUES {GRID}) g(threshold) GROUP BY 1, 2"
)
add(
    "threshold_sweep",
    lambda t: rounded(policy.threshold_sweep(t.scored_long()), *MONEY),
    with_views("scored_long", f"SELECT model, threshold, tp, tn, fp, fn, {utility_sql()} FROM k", **SWEEP),
)
STRATEGY = dict(
    s="SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', {c}::DOUBLE)" for a, b, c in policy.STRATEGIES) + ") s(strategy, model, threshold)",
    k="SELECT strategy, threshold, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp, count(*) FILTER (WHERE score < threshold AND label = 0) AS tn, "
    "count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp, count(*) FILTER (WHERE score < threshold AND label = 1) AS fn "
    "FROM scored_long JOIN s USING (model) GROUP BY 1, 2 UNION ALL SELECT 'baseline', 0.0::DOUBLE, 0, 0, 0, 0",
)
add(
    "strategy_compare",
    lambda t: rounded(policy.strategy_compare(t.scored_long()), *MONEY),
    with_views("scored_long", f"SELECT strategy, threshold, tp, tn, fp, fn, {utility_sql()} FROM k", **STRATEGY),
)
for metric in ("mb_saved", "net_utility_usd"):
    add(
        "best_threshold_by_saving" if metric == "mb_saved" else "best_threshold_by_net_utility",
        lambda t, m=metric: rounded(policy.best_threshold(policy.threshold_sweep(t.scored_long()), m), *MONEY),
        with_views(
            "scored_long",
            f"SELECT model, threshold, tp, tn, fp, fn, {utility_sql()} FROM k "
            f"QUALIFY row_number() OVER (PARTITION BY model ORDER BY {metric} DESC, threshold) = 1",
            **SWEEP,
        ),
    )
add(
    "risk_tier_4",
    lambda t: t.scored.select(X.risk_tier_4("champion").alias("tier"), "label").groupBy("tier").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives")
    ),
    with_views(
        "scored",
        "SELECT CASE WHEN champion >= 0.776 THEN 'CRITICAL' WHEN champion >= 0.45 THEN 'HIGH' WHEN champion >= 0.35 THEN 'MODERATE' ELSE 'SAFE' END AS tier, "
        "count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM scored GROUP BY 1",
    ),
)

# --- gates ------------------------------------------------------------------------------------------
for name, gain, precision in (("challenger_gate", 0.002, 0.75), ("challenger_gate_loose", -1.0, 0.2)):
    add(
        name,
        lambda t, g=gain, p=precision: rounded(
            evaluate.challenger_gate(models.model_metrics(t.scored_long(), 0.73, "holdout"), "high_recall", "champion", g, p),
            "champion_auc", "challenger_auc", "precision", "gain",
        ),
        with_views(
            "scored_long",
            f"SELECT {rnd('a', SIX)} AS champion_auc, {rnd('b', SIX)} AS challenger_auc, {rnd('p', SIX)} AS precision, {rnd('b - a', SIX)} AS gain, "
            f"CAST(b - a >= {gain} AND p >= {precision} AS INTEGER) AS promoted FROM (SELECT max(area) FILTER (WHERE model = 'champion') AS a, "
            "max(area) FILTER (WHERE model = 'high_recall') AS b FROM auc), (SELECT tp / (tp + fp) AS p FROM k WHERE model = 'high_recall')",
            **AUC, k=counts(0.73),
        ),
    )


def runs(t):
    e = t.table("events")
    return e.select(F.col("ts").alias("finished_at"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))


for name, day in (("retrain_gate", "2024-06-01"), ("retrain_gate_same_day", "2024-01-05")):
    add(
        name,
        lambda t, d=day: evaluate.retrain_gate(t.audit, runs(t), d),
        with_views(
            "audit",
            "SELECT resolved, n AS runs_today, CAST(resolved >= 100 AS INTEGER) AS triggered, CAST(resolved >= 50 AS INTEGER) AS enough_samples, "
            "CAST(resolved >= 100 AND n = 0 AS INTEGER) AS should_retrain FROM (SELECT count(*) FILTER (WHERE status = 'RESOLVED' OR actual_skipped IS NOT NULL) AS resolved FROM audit), "
            f"(SELECT count(*) FILTER (WHERE event_type <> 'error' AND CAST(ts AS DATE) = DATE '{day}') AS n FROM events)",
        ),
    )
add(
    "score_batch",
    lambda t: evaluate.decide(
        t.table("events").select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("event_id") * 37 % 1000 / 1000).alias("prob")), 0.749
    ).drop("prob"),
    "SELECT event_id, " + rnd("p", 4) + " AS skip_probability, CAST(p >= 0.749 AS INTEGER) AS is_skip_predicted, "
    "CASE WHEN p >= 0.749 THEN 'CRITICAL' WHEN p < 0.35 THEN 'LOW' ELSE 'MODERATE' END AS risk_tier, "
    "CASE WHEN p >= 0.749 THEN 'JIT_3SEC_CHUNKING (Stop 30s prefetch to save bandwidth)' ELSE 'STANDARD_PREFETCH' END AS cdn_policy, "
    "CASE WHEN p >= 0.749 THEN 'SILENT_AUTOPLAY_PURGE (Silently drop track before playback)' ELSE 'KEEP_IN_QUEUE' END AS recommender_policy, "
    "CASE WHEN p >= 0.749 THEN printf('High skip probability (%.1f%%) exceeds SLA threshold (74.9%%).', p * 100) "
    "ELSE printf('Safe skip probability (%.1f%%). User is in flow state.', p * 100) END AS explanation "
    "FROM (SELECT event_id, coalesce(CASE WHEN event_id % 13 <> 0 THEN event_id * 37 % 1000 / 1000 END, 0.35) AS p FROM events)",
)


# --- queue forecast -----------------------------------------------------------------------------------
def listener_sessions(t):
    """Each listener's newest play with the state known at it."""
    state = ["skips_last_3m", "skips_last_15m", "seconds_since_last_skip", "previous_song_skipped", "consecutive_listens_streak"]
    f = features.feature_matrix(t.plays).select("user_id", "event_id", *state)
    at = F.struct("time_stamp", "event_id")
    last = t.plays.groupBy("user_id").agg(
        F.max_by(F.struct("event_id", "song_name", "artist_name", "reason_start", "platform", "shuffle", F.col("time_stamp").alias("asked_at")), at).alias("p")
    ).select("user_id", "p.*")
    joined = last.join(f, ["user_id", "event_id"])
    return joined.select(
        "user_id", F.col("song_name").alias("current_song"), F.col("artist_name").alias("current_artist"),
        F.coalesce("reason_start", F.lit("trackdone")).alias("reason_start"), "platform", "shuffle", "asked_at", *state,
    )


def upcoming(t):
    """A listener's purchased tracks stand for the queue, the five newest first; the web player shows no queue."""
    from playlens.operators.rank import topn_per_group

    bought = t.plays.where("reason_end = 'endplay' and platform <> 'web_player'")
    top = topn_per_group(bought, ["user_id"], "time_stamp", ["event_id"], 5)
    return top.select("user_id", F.col("rank").alias("queue_position"), "song_name", "artist_name")


def linear_score(df):
    p = (
        F.col("artist_smoothed_skip_rate") * 0.5 + F.col("song_smoothed_skip_rate") * 0.5
        + F.col("reason_start_smoothed_skip_rate") * 0.25 + F.col("previous_song_skipped") * 0.125
    )
    return df.withColumn("prob", F.least(p, F.lit(1.0)))


def forecast(t):
    return queue.queue_forecast(listener_sessions(t), upcoming(t), *lookups(t), linear_score, 0.30)


RISK = "CAST(CASE {0} WHEN 'trackdone' THEN 0.025 WHEN 'clickrow' THEN 0.120 WHEN 'fwdbtn' THEN 0.604 WHEN 'backbtn' THEN 0.400 WHEN 'playbtn' THEN 0.050 ELSE 0.104 END AS DOUBLE)"
FORECAST = dict(
    **LOOKUPS,
    w="SELECT *, lag(is_skip) OVER (PARTITION BY user_id ORDER BY time_stamp, event_id) AS prev FROM b",
    ses="SELECT user_id, song_name, artist_name, coalesce(reason_start, 'trackdone') AS rs, coalesce(prev, 0) AS prev FROM w "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, event_id DESC) = 1",
    q="SELECT user_id, song_name, artist_name, CAST(row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, event_id) AS INTEGER) AS pos "
    "FROM plays WHERE reason_end = 'endplay' AND platform <> 'web_player' QUALIFY pos <= 5",
    x="SELECT q.user_id, q.song_name, q.artist_name, q.pos, s.rs, s.prev FROM q JOIN ses s USING (user_id) UNION ALL "
    "SELECT user_id, song_name, artist_name, 0, 'clickrow', 0 FROM ses WHERE user_id NOT IN (SELECT user_id FROM q)",
    fc="SELECT x.*, least(coalesce(al.rate, 0.104) * 0.5::DOUBLE + coalesce(sl.rate, al.rate, 0.104) * 0.5::DOUBLE + "
    + RISK.format("rs")
    + " * 0.25::DOUBLE + prev * 0.125::DOUBLE, 1.0) AS p FROM x LEFT JOIN al ON al.lookup_key = lower(trim(x.artist_name)) "
    "LEFT JOIN sl ON sl.lookup_key = lower(trim(x.song_name))",
)
add(
    "queue_forecast",
    lambda t: forecast(t).select("user_id", "queue_position", "song_name", "artist_name", "skip_probability", "is_skip_predicted", "risk_tier"),
    with_views(
        "plays",
        f"SELECT user_id, pos AS queue_position, song_name, artist_name, {rnd('p', 4)} AS skip_probability, CAST(p >= 0.30 AS INTEGER) AS is_skip_predicted, "
        "CASE WHEN p >= 0.30 THEN 'CRITICAL' WHEN p < 0.35 THEN 'LOW' ELSE 'MODERATE' END AS risk_tier FROM fc",
        **FORECAST,
    ),
)
add(
    "queue_directive",
    lambda t: queue.queue_directive(forecast(t)),
    with_views(
        "plays",
        "SELECT user_id, tracks, high_risk, CASE WHEN high_risk > 0 THEN 'ACTION_REQUIRED: Detected ' || high_risk || ' high-risk tracks in upcoming queue. "
        "Triggering JIT buffer throttling and silent purge.' ELSE 'OPTIMAL_FLOW: All upcoming tracks below skip threshold. Safe for full 30s CDN pre-fetch.' END AS directive "
        "FROM (SELECT user_id, count(*) AS tracks, count(*) FILTER (WHERE p >= 0.30 AND pos > 0) AS high_risk FROM fc GROUP BY 1)",
        **FORECAST,
    ),
)

QUEUE = ["user_id", "queue_position", "song_name", "artist_name"]
ROUNDED = [c for c in features.FEATURE_COLUMNS if c.endswith("_rate") or c in ("hour_sin", "hour_cos", "seconds_since_last_skip")]
CONTEXT = {
    "skips_last_3m": "0", "skips_last_15m": "0", "seconds_since_last_skip": "10000.0::DOUBLE", "previous_song_skipped": "0", "consecutive_listens_streak": "0",
}
add(
    "queue_features",
    lambda t: rounded(queue.queue_features(listener_sessions(t), upcoming(t), *lookups(t)), *ROUNDED).select(*QUEUE, *features.FEATURE_COLUMNS),
    with_views(
        "plays",
        "SELECT user_id, queue_position, song_name, artist_name, ar AS artist_smoothed_skip_rate, sr AS song_smoothed_skip_rate, "
        f"ar AS genre_smoothed_skip_rate, ar AS album_smoothed_skip_rate, {RISK.format('rs')} AS reason_start_smoothed_skip_rate, cold AS is_cold_start_artist, "
        + ", ".join(CONTEXT)
        + ", CAST(contains(lower(platform), 'android') AS INTEGER) AS platform_android, "
        "CAST(contains(lower(platform), 'win') AND NOT contains(lower(platform), 'android') AS INTEGER) AS platform_windows, shuffle AS shuffle_mode, "
        "CAST(consecutive_listens_streak = 0 AS INTEGER) AS is_session_start, CAST(hour(asked) AS INTEGER) AS hour_of_day, "
        f"CAST(isodow(asked) - 1 AS INTEGER) AS day_of_week, {rnd('sin(2 * pi() * hour(asked) / 24)', SIX)} AS hour_sin, {rnd('cos(2 * pi() * hour(asked) / 24)', SIX)} AS hour_cos FROM qr",
        **FORECAST,
        fm=matrix_sql("plays"),
        last="SELECT p.*, p.time_stamp AS asked FROM plays p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time_stamp DESC, event_id DESC) = 1",
        state=f"SELECT l.user_id, l.platform, l.shuffle, l.asked, {', '.join('fm.' + c for c in CONTEXT)} FROM last l JOIN fm ON fm.user_id = l.user_id AND fm.event_id = l.event_id",
        qx="SELECT x.user_id, x.pos AS queue_position, x.song_name, x.artist_name, x.rs, s.platform, s.shuffle, s.asked, "
        + ", ".join(f"CASE WHEN x.pos = 0 THEN {default} ELSE s.{c} END AS {c}" for c, default in CONTEXT.items())
        + " FROM x JOIN state s ON s.user_id = x.user_id",
        qr=f"SELECT qx.*, CAST(al.lookup_key IS NULL AS INTEGER) AS cold, {rnd('coalesce(al.rate, 0.104)', SIX)} AS ar, "
        f"{rnd('coalesce(sl.rate, al.rate, 0.104)', SIX)} AS sr FROM qx LEFT JOIN al ON al.lookup_key = lower(trim(artist_name)) LEFT JOIN sl ON sl.lookup_key = lower(trim(song_name))",
    ),
)


# --- training: tree learners have no SQL form, so the queries return what must hold for any fit ----------------
SMALL = {"maxIter": 8, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5"}


def folds(t):
    """Features of all plays, stored once because training reads them many times, split 70 / 30 by time."""
    from playlens.session import materialize

    f = materialize(features.feature_matrix(t.plays), "training")
    both = splits.by_fraction(f, 0.7)
    return both.where("split = 'train'"), both.where("split = 'test'")


def follows(p, threshold):
    """Does the decision of a row follow from its probability?"""
    return (F.col("is_skip_predicted") == (p >= threshold).cast("int")) & (F.col("risk_tier") == X.risk_tier_3(p, threshold))


def trained(t, fit, name):
    """One row: the later fold's records and skips, whether all scores are in [0, 1], and whether the fitted rows rank
    better than chance."""
    train, test = folds(t)
    model = fit(train)
    fitted = evaluate.roc_auc(models.score(model, train, name)).select("model", (F.col("roc_auc") > 0.5).alias("fits_training_rows"))
    scored = models.score(model, test, name).groupBy("model").agg(
        F.count(F.lit(1)).alias("records"), F.sum("label").cast("bigint").alias("skips"), F.every(F.col("score").between(0, 1)).alias("scores_in_range")
    )
    return scored.join(fitted, "model")


LATER = dict(b=skipped_view("plays"), later=f"SELECT b.* FROM b JOIN ({RANKED.format('b')}) k USING (event_id) WHERE r > trunc(n * 0.7::DOUBLE)")


def trained_sql(name):
    return with_views("plays", f"SELECT '{name}' AS model, count(*) AS records, CAST(sum(is_skip) AS BIGINT) AS skips, true AS scores_in_range, true AS fits_training_rows FROM later", **LATER)


add("train_forest", lambda t: trained(t, lambda d: models.train_forest(d, trees=20, depth=6), "forest"), trained_sql("forest"))
add("train_boosted", lambda t: trained(t, lambda d: models.train_boosted(d, SMALL), "champion"), trained_sql("champion"))
add("train_high_recall", lambda t: trained(t, lambda d: models.train_high_recall(d, SMALL), "high_recall"), trained_sql("high_recall"))


def importance_checks(t):
    found = models.importances(models.train_forest(folds(t)[0], trees=20, depth=6))
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))  # one row per feature
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


# --- training on a planted rule: what the learner must find is known, so its decisions are compared one by one --
def planted(t, fit, name):
    """Confusion counts on the later fold of a learner whose labels follow a rule: plays in shuffle mode are the skipped ones."""
    train, test = (d.withColumn("is_skip", F.col("shuffle_mode")) for d in folds(t))
    scored = models.score(fit(train), test, name)
    says = (F.col("score") >= 0.5).cast("int")
    return scored.groupBy("model").agg(*[F.count_if((F.col("label") == a) & (says == b)).alias(f"label_{a}_says_{b}") for a in (0, 1) for b in (0, 1)])


def planted_sql(name):
    found = ", ".join(f"count(*) FILTER (WHERE shuffle = {a} AND {a} = {b}) AS label_{a}_says_{b}" for a in (0, 1) for b in (0, 1))
    return with_views("plays", f"SELECT '{name}' AS model, {found} FROM later", **LATER)


add("train_forest_rule", lambda t: planted(t, lambda d: models.train_forest(d, trees=20, depth=6), "forest"), planted_sql("forest"))
add("train_boosted_rule", lambda t: planted(t, lambda d: models.train_boosted(d, SMALL), "champion"), planted_sql("champion"))


def planted_importance(t):
    """The most important feature of a forest that has learned the rule."""
    train = folds(t)[0].withColumn("is_skip", F.col("shuffle_mode"))
    found = models.importances(models.train_forest(train, trees=20, depth=6))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"))  # one row per feature
    return found.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("feature", "rank")


TELLING = {"shuffle_mode": "shuffle", "hour_of_day": "hour(time_stamp)", "day_of_week": "isodow(time_stamp)", "platform_windows": "CAST(user_id % 7 = 1 AS INTEGER)"}
add(
    "feature_importance_rule",
    planted_importance,
    # the column that goes with the label most closely
    with_views(
        "plays",
        "SELECT feature, 1 AS rank FROM c ORDER BY abs(r) DESC LIMIT 1",
        c=" UNION ALL ".join(f"SELECT '{n}' AS feature, corr({x}, shuffle) AS r FROM plays" for n, x in TELLING.items()),
    ),
)

FEATURE_LIST = ", ".join(f"'{c}'" for c in features.FEATURE_COLUMNS)
add("feature_importance", importance_checks, f"SELECT unnest([{FEATURE_LIST}]) AS feature, true AS in_range, true AS sums_to_one")

GRID = {**{k: [v] for k, v in SMALL.items()}, "maxIter": [4], "maxDepth": [2, 4]}
add(
    "tune_temporal",
    lambda t: models.tune_temporal(*folds(t), GRID).select(
        "trial", F.regexp_extract("settings", "'maxDepth': ([0-9]+)", 1).cast("int").alias("depth"),
        F.col("safe_recall").between(0, 1).alias("recall_in_range"), F.col("threshold").between(0, 1).alias("threshold_in_range"),
    ),
    "SELECT unnest([0, 1]) AS trial, unnest([2, 4]) AS depth, true AS recall_in_range, true AS threshold_in_range",
)


def persisted(t):
    """The later fold scored by the stored pipeline: its scores are those of the fitted one, and decisions follow from them."""
    from playlens.session import scratch_path

    train, test = folds(t)
    path = scratch_path(t.spark, "model")
    fitted = models.train_boosted(train, SMALL)
    before = models.score(fitted, test, "champion")
    best = evaluate.threshold_f1(before).first()
    models.save_model(fitted, path, best["threshold"], {"f1": best["f1"]})
    loaded, meta = models.load_model(t.spark, path)
    decided = evaluate.decide(models.score(loaded, test, "champion").withColumnRenamed("score", "prob"), meta["threshold"])
    return decided.join(before.select("user_id", "event_id", "score"), ["user_id", "event_id"]).select(
        "user_id", "event_id", F.col("label").cast("int").alias("label"), (F.abs(F.col("prob") - F.col("score")) < 1e-12).alias("same_score"),
        follows(F.col("prob"), meta["threshold"]).alias("decision_follows"),
    )


add(
    "persist_model",
    persisted,
    with_views("plays", "SELECT user_id, event_id, CAST(is_skip AS INTEGER) AS label, true AS same_score, true AS decision_follows FROM later", **LATER),
)


def fitted_forecast(t):
    """The queue scored by a pipeline fitted on the earlier fold."""
    model = models.train_boosted(folds(t)[0], SMALL)
    out = queue.queue_forecast(listener_sessions(t), upcoming(t), *lookups(t), models.scorer(model), 0.45)
    return out.select(*QUEUE, F.col("prob").between(0, 1).alias("prob_in_range"), follows(F.col("prob"), 0.45).alias("decision_follows"))


add(
    "queue_forecast_fitted",
    fitted_forecast,
    with_views("plays", "SELECT user_id, pos AS queue_position, song_name, artist_name, true AS prob_in_range, true AS decision_follows FROM x", **FORECAST),
)
