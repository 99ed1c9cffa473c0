"""Causal features: priors, target encodings, momentum, look-back windows and the flagship matrix."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import features
from playlens.operators.asof import asof_join
from playlens.operators.feature_store import FeatureStore
from playlens.plans.engagement_queries import FAMILY
from playlens.plans.oracle import HOUR, WEEKDAY, YEAR, rnd, with_views
from playlens.plans.registry import add
from playlens.session import scratch_path

ORD = "ORDER BY time_stamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
KEYS = {
    "artist": "artist_name",
    "song": "song_name",
    "genre": "lower(trim(tags[1]))",
    "album": "coalesce(album_name, 'unknown')",
    "reason_start": "coalesce(reason_start, 'unknown')",
}
SIX = 6


def past(key=None):
    by = "user_id" + (f", {key}" if key else "")
    w = f"OVER (PARTITION BY {by} {ORD})"
    return f"CAST(count(*) {w} AS BIGINT)", f"CAST(coalesce(sum(is_skip) {w}, 0) AS BIGINT)"


def skipped_view(view):
    return f"SELECT *, CAST(coalesce(reason_end = 'fwdbtn', false) AS INTEGER) AS is_skip FROM {view}"


def prior_view():
    n, s = past()
    return f"SELECT *, {n} AS past_plays, {s} AS past_skips, {s} / greatest({n}, 1) AS prior FROM b"


def rounded(df, *columns):
    return df.withColumns({c: X.round_even(c, SIX) for c in columns})


def rate_sql(key):
    n, s = past(key)
    return f"({s} + prior * 20) / ({n} + 20)"


add(
    "global_prior_expanding",
    lambda t: rounded(features.global_prior(t.plays), "rolling_global_skip_rate"),
    with_views(
        "plays",
        f"SELECT user_id, event_id, past_plays, past_skips, {rnd('prior', SIX)} AS rolling_global_skip_rate FROM p",
        b=skipped_view("plays"), p=prior_view(),
    ),
)
add(
    "global_prior_all_users",
    lambda t: rounded(
        features.global_prior(t.plays.withColumns({"listener": F.col("user_id"), "user_id": F.lit(0).cast("bigint")})),
        "rolling_global_skip_rate",
    ),
    with_views(
        "plays",
        f"SELECT user_id, event_id, past_plays, past_skips, {rnd('prior', SIX)} AS rolling_global_skip_rate FROM p",
        b="SELECT 0::BIGINT AS user_id, event_id, time_stamp, skipped AS is_skip FROM plays", p=prior_view(),
    ),
)
for entity, key in KEYS.items():
    n, s = past(key)
    for view in ("plays", "plays_long"):
        add(
            f"target_encode_{entity}" + ("_long" if view == "plays_long" else ""),
            lambda t, e=entity, v=view: rounded(features.target_encode(getattr(t, v), e), f"{e}_smoothed_skip_rate"),
            with_views(
                view,
                f"SELECT user_id, event_id, {n} AS {entity}_past_plays, {s} AS {entity}_past_skips, "
                f"{rnd(rate_sql(key), SIX)} AS {entity}_smoothed_skip_rate FROM p",
                b=skipped_view(view), p=prior_view(),
            ),
        )
n, s = past("artist_name")
add(
    "target_encode_static_prior",
    lambda t: rounded(features.target_encode_static(t.plays, "artist"), "artist_smoothed_skip_rate"),
    with_views(
        "plays",
        f"SELECT user_id, event_id, {rnd(f'({s} + (SELECT sum(is_skip) / count(*) FROM b) * 20) / ({n} + 20)', SIX)} "
        "AS artist_smoothed_skip_rate FROM b",
        b=skipped_view("plays"),
    ),
)
add(
    "target_encode_multitag",
    lambda t: rounded(features.target_encode_multitag(t.plays), "genre_multitag_skip_rate"),
    with_views(
        "plays",
        f"SELECT user_id, event_id, {rnd('avg(r)', SIX)} AS genre_multitag_skip_rate, count(*) AS tag_count FROM "
        "(SELECT user_id, event_id, (coalesce(sum(is_skip) OVER w, 0) + prior * 20) / (count(*) OVER w + 20) AS r FROM x "
        "WINDOW w AS (PARTITION BY user_id, tag ORDER BY q RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) GROUP BY 1, 2",
        b=skipped_view("plays"),
        p=prior_view(),
        o="SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY time_stamp, event_id) AS q FROM p",
        x="SELECT *, lower(trim(unnest(tags))) AS tag FROM o",
    ),
)
add(
    "cold_start_artist",
    lambda t: features.cold_start_artist(t.plays),
    with_views("plays", f"SELECT user_id, event_id, CAST({n} < 3 AS INTEGER) AS is_cold_start_artist FROM b", b=skipped_view("plays")),
)
W = "OVER (PARTITION BY user_id ORDER BY time_stamp, event_id)"
STREAK = dict(
    q=f"SELECT *, CAST(coalesce(lag(is_skip) {W}, 0) AS INTEGER) AS previous_song_skipped, epoch_us(time_stamp) - epoch_us(lag(time_stamp) {W}) AS gap FROM p",
    g=f"SELECT *, sum(previous_song_skipped) {W} AS grp FROM q",
    m="SELECT *, row_number() OVER (PARTITION BY user_id, grp ORDER BY time_stamp, event_id) - 1 AS consecutive_listens_streak, "
    "CAST(coalesce(gap > 1200000000, true) AS INTEGER) AS is_session_start FROM g",
)
for name, column in (
    ("previous_skipped", "previous_song_skipped"),
    ("listen_streak", "consecutive_listens_streak"),
    ("session_start_flag", "is_session_start"),
):
    for view in ("plays", "plays_long"):
        add(
            name + ("_long" if view == "plays_long" else ""),
            lambda t, c=column, v=view: features.momentum_features(getattr(t, v)).select("user_id", "event_id", c),
            with_views(view, f"SELECT user_id, event_id, {column} FROM m", b=skipped_view(view), p=prior_view(), **STREAK),
        )


def as_of_ctes(view):
    return dict(
        b=skipped_view(view),
        l="SELECT user_id, event_id, time_stamp, is_skip, max(CASE WHEN is_skip = 1 THEN epoch_us(time_stamp) END) OVER "
        "(PARTITION BY user_id ORDER BY epoch_us(time_stamp) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_us FROM b",
    )


SINCE = rnd("coalesce((epoch_us(time_stamp) - last_us) / 1000000, 10000)", SIX)
for view in ("plays", "plays_long"):
    suffix = "_long" if view == "plays_long" else ""
    add(
        "asof_last_skip" + suffix,
        lambda t, v=view: features.last_skip(getattr(t, v)).select("user_id", "event_id", F.unix_micros("last_skip_time").alias("last_skip_us")),
        with_views(view, "SELECT user_id, event_id, last_us AS last_skip_us FROM l", **as_of_ctes(view)),
    )
    add(
        "seconds_since_last_skip" + suffix,
        lambda t, v=view: rounded(features.last_skip(getattr(t, v)).drop("last_skip_time"), "seconds_since_last_skip"),
        with_views(view, f"SELECT user_id, event_id, {SINCE} AS seconds_since_last_skip FROM l", **as_of_ctes(view)),
    )


# --- as-of join of two tables -------------------------------------------------------------------
def latest_prediction(t, **how):
    """Each play with the last prediction for its track."""
    p = t.predictions.select("user_id", "song_name", "made_at", "event_id", "prob", "flagged")
    plays = t.plays.select("user_id", "event_id", "time_stamp", "song_name", "skipped")
    found = asof_join(plays, p, ["user_id", "song_name"], "time_stamp", "made_at", prefix="seen_", **how)
    return found.select("user_id", "event_id", "skipped", F.unix_micros("seen_made_at").alias("made_us"), "seen_event_id", "seen_prob", "seen_flagged")


def latest_prediction_sql(op, within=None):
    """DuckDB's ASOF JOIN takes any of equal times: only the largest is left to it."""
    near = f"epoch_us(time_stamp) - epoch_us(made_at) <= {within}" if within else "true"
    columns = {"epoch_us(made_at)": "made_us", "o.event_id": "seen_event_id", "prob": "seen_prob", "flagged": "seen_flagged"}
    return with_views(
        "plays predictions",
        "SELECT plays.user_id, plays.event_id, plays.skipped, " + ", ".join(f"CASE WHEN {near} THEN {c} END AS {n}" for c, n in columns.items())
        + f" FROM plays ASOF LEFT JOIN o ON plays.user_id = o.user_id AND plays.song_name = o.song_name AND plays.time_stamp {op} o.made_at",
        m="SELECT user_id, song_name, made_at, max(struct_pack(event_id := event_id, prob := prob, flagged := flagged)) AS x FROM predictions GROUP BY 1, 2, 3",
        o="SELECT user_id, song_name, made_at, x.event_id AS event_id, x.prob AS prob, x.flagged AS flagged FROM m",
    )


add("asof_latest_prediction", latest_prediction, latest_prediction_sql(">="))
add("asof_earlier_prediction", lambda t: latest_prediction(t, strict=True), latest_prediction_sql(">"))
add("asof_recent_prediction", lambda t: latest_prediction(t, tolerance=3 * 86400), latest_prediction_sql(">=", 3 * 86400 * 1000000))


def skip_before_order(t):
    """The last skip of a listener's order history before each play, over two tables: numbers of days as times."""
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    plays = t.plays.select((F.col("user_id") % 40).alias("listener"), "event_id", day("time_stamp").alias("day"))
    skips = t.plays_long.where("skipped = 1").groupBy(F.col("user_id").alias("listener"), day("time_stamp").alias("day")).agg(F.count(F.lit(1)).alias("skips"))
    return asof_join(plays, skips, ["listener"], "day", strict=True, prefix="before_")


add(
    "asof_skip_days",
    skip_before_order,
    with_views(
        "plays plays_long",
        "SELECT l.listener, l.event_id, l.day, r.day AS before_day, r.skips AS before_skips FROM l ASOF LEFT JOIN r ON l.listener = r.listener AND l.day > r.day",
        l="SELECT user_id % 40 AS listener, event_id, CAST(date_diff('day', DATE '1970-01-01', CAST(time_stamp AS DATE)) AS INTEGER) AS day FROM plays",
        r="SELECT user_id AS listener, CAST(date_diff('day', DATE '1970-01-01', CAST(time_stamp AS DATE)) AS INTEGER) AS day, count(*) AS skips FROM plays_long WHERE skipped = 1 GROUP BY 1, 2",
    ),
)


def rolling_sql(sec):
    """Skips in (t - W, t] among rows that come earlier in (time, id) order."""
    us = sec * 1000000
    return (
        "CAST(coalesce(sum(is_skip) OVER (PARTITION BY user_id ORDER BY epoch_us(time_stamp) "
        f"RANGE BETWEEN {us - 1} PRECEDING AND 1 PRECEDING), 0) + coalesce(sum(is_skip) OVER "
        "(PARTITION BY user_id, time_stamp ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)"
    )


for name, view, spans in (
    ("rolling_skips", "plays", {"skips_last_3m": 180, "skips_last_15m": 900}),
    ("rolling_skips_6h_24h", "plays", {"skips_last_6h": 21600, "skips_last_24h": 86400}),
    ("rolling_skips_long", "plays_long", {"skips_last_day": 86400, "skips_last_30d": 30 * 86400}),
):
    add(
        name,
        lambda t, v=view, w=spans: features.rolling_skips(getattr(t, v), w),
        with_views(
            view,
            "SELECT user_id, event_id, " + ", ".join(f"{rolling_sql(sec)} AS {c}" for c, sec in spans.items()) + " FROM b",
            b=skipped_view(view),
        ),
    )

RATES = [f"{e}_smoothed_skip_rate" for e in KEYS]
REAL = [*RATES, "rolling_global_skip_rate", "hour_sin", "hour_cos", "seconds_since_last_skip"]


def matrix_sql(view):
    return with_views(
        view,
        f"SELECT m.user_id, m.event_id, m.time_stamp, m.is_skip, {HOUR.replace('time_stamp', 'm.time_stamp')} AS hour_of_day, "
        f"{WEEKDAY.replace('time_stamp', 'm.time_stamp')} AS day_of_week, CAST(day(m.time_stamp) AS INTEGER) AS day_of_month, "
        f"{YEAR.replace('time_stamp', 'm.time_stamp')} AS year, "
        f"{rnd('sin(2 * pi() * hour(m.time_stamp) / 24)', SIX)} AS hour_sin, {rnd('cos(2 * pi() * hour(m.time_stamp) / 24)', SIX)} AS hour_cos, "
        f"{rnd('prior', SIX)} AS rolling_global_skip_rate, "
        + ", ".join(f"{e}_smoothed_skip_rate" for e in KEYS)
        + ", is_cold_start_artist, "
        + ", ".join(f"CAST({FAMILY} = '{x}' AS INTEGER) AS platform_{x}" for x in ("android", "windows", "linux"))
        + ", shuffle AS shuffle_mode, previous_song_skipped, consecutive_listens_streak, "
        + SINCE.replace("time_stamp", "m.time_stamp")
        + " AS seconds_since_last_skip, skips_last_3m, skips_last_15m, skips_last_24h, is_session_start "
        "FROM m JOIN e ON e.user_id = m.user_id AND e.event_id = m.event_id",
        b=skipped_view(view),
        p=prior_view(),
        **STREAK,
        e="SELECT user_id, event_id, "
        + ", ".join(f"{rnd(rate_sql(k), SIX)} AS {e}_smoothed_skip_rate" for e, k in KEYS.items())
        + f", CAST({past('artist_name')[0]} < 3 AS INTEGER) AS is_cold_start_artist, "
        + f"{rolling_sql(180)} AS skips_last_3m, {rolling_sql(900)} AS skips_last_15m, {rolling_sql(86400)} AS skips_last_24h, "
        "max(CASE WHEN is_skip = 1 THEN epoch_us(time_stamp) END) OVER (PARTITION BY user_id ORDER BY epoch_us(time_stamp) "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_us FROM p",
    )


for name, view in (("feature_matrix", "plays"), ("feature_matrix_long", "plays_long")):
    add(
        name,
        lambda t, v=view: rounded(features.feature_matrix(getattr(t, v), {"skips_last_24h": 86400}), *REAL),
        matrix_sql(view),
    )


def daily_features(t, view, batches=3):
    """The matrix by way of the feature store: the history comes in batches, and each reads its own plays and the carry."""
    plays = getattr(t, view)
    store = FeatureStore(t.spark, scratch_path(t.spark, "feature-store"), {"skips_last_24h": 86400})
    at = F.unix_micros("time_stamp")
    lo, hi = plays.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - lo) * batches / (hi - lo + 1))
    for i in range(batches):
        store.append(plays.where(part == i), i)
    return rounded(store.features(), *REAL)


add("feature_store_batches", lambda t: daily_features(t, "plays"), matrix_sql("plays"))
add("feature_store_batches_long", lambda t: daily_features(t, "plays_long"), matrix_sql("plays_long"))
add(
    "feature_presence_gate",
    lambda t: rounded(features.ensure_features(t.plays).select("user_id", "event_id", *features.FEATURE_COLUMNS[:2]), *features.FEATURE_COLUMNS[:2]),
    with_views(
        "plays",
        "SELECT user_id, event_id, " + ", ".join(f"{rnd(rate_sql(KEYS[e]), SIX)} AS {e}_smoothed_skip_rate" for e in ("artist", "song")) + " FROM p",
        b=skipped_view("plays"), p=prior_view(),
    ),
)
add(
    "chronological_order",
    lambda t: features.global_prior(t.plays_long).select("user_id", "event_id", (F.col("past_plays") + 1).alias("position")),
    with_views("plays_long", f"SELECT user_id, event_id, row_number() {W} AS position FROM plays_long"),
)
