"""Volume, trend, heat-map, session and island queries."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import islands, sessions, temporal
from playlens.plans.oracle import (
    ABS_MONTH, DATE, HOUR, MONTH_START, SEASON, WEEKDAY, YEAR, duration, rnd, with_views,
)
from playlens.plans.registry import add

HALF_DAY = 12 * 3600

add(
    "history_summary",
    lambda t: temporal.history_summary(t.plays),
    with_views(
        "plays",
        f"SELECT *, {rnd('total_seconds / 3600', 2)} AS total_hours, {duration('total_seconds')} AS total_time FROM a",
        a="SELECT count(*) AS plays, CAST(min(time_stamp) AS DATE) AS first_day, CAST(max(time_stamp) AS DATE) AS last_day, "
        "CAST(sum(sec_played) AS BIGINT) AS total_seconds FROM plays",
    ),
)
for period, expr, label, view in (
    ("year", YEAR, "year", "plays_long"), ("month", MONTH_START, "period", "plays_long"), ("day", DATE, "period", "plays"),
):
    add(
        f"volume_{period}",
        lambda t, p=period, v=view: temporal.volume(getattr(t, v), p),
        with_views(
            view,
            f"SELECT *, {rnd('total_seconds / 3600', 1)} AS hours, {duration('total_seconds')} AS total_time FROM a",
            a=f"SELECT {expr} AS {label}, count(song_name) AS plays, CAST(sum(sec_played) AS BIGINT) AS total_seconds "
            f"FROM {view} GROUP BY 1",
        ),
    )


def bucket_sql(label, expr):
    return with_views(
        "plays",
        f"SELECT {label}, plays, total_seconds, {rnd('total_seconds / 3600', 1)} AS hours, "
        f"{rnd('plays / (SELECT count(*) FROM plays) * 100', 2)} AS share FROM a",
        a=f"SELECT {expr} AS {label}, count(song_name) AS plays, CAST(sum(sec_played) AS BIGINT) AS total_seconds FROM plays GROUP BY 1",
    )


add("volume_weekday", lambda t: temporal.volume_by(t.plays, weekday=F.weekday("time_stamp")), bucket_sql("weekday", WEEKDAY))
add("volume_hour", lambda t: temporal.volume_by(t.plays, hour=F.hour("time_stamp")), bucket_sql("hour", HOUR))

DAYPART = (
    "CASE WHEN h >= 5 AND h < 12 THEN 'Morning' WHEN h >= 12 AND h < 17 THEN 'Afternoon' "
    "WHEN h >= 17 AND h < 19.5 THEN 'Evening' WHEN h >= 19.5 AND h < 24 THEN 'Night' ELSE 'Midnight' END"
)
POSITION = "CAST(list_position(['Morning','Afternoon','Evening','Night','Midnight'], daypart) AS INTEGER) AS position"
DAYPARTS = dict(
    h="SELECT *, hour(time_stamp) + minute(time_stamp) / 60 AS h FROM plays",
    a=f"SELECT {DAYPART} AS daypart, count(*) AS plays FROM h GROUP BY 1",
)
add("volume_daypart", lambda t: temporal.volume_daypart(t.plays), with_views("plays", f"SELECT *, {POSITION} FROM a", **DAYPARTS))

HOURS = list(range(24))
PIVOT = ", ".join(f"nullif(count(*) FILTER (WHERE hour(time_stamp) = {h}), 0) AS h{h:02d}" for h in HOURS)
add(
    "traffic_heatmap",
    lambda t: temporal.traffic_heatmap(t.plays),
    with_views("plays", f"SELECT {WEEKDAY} AS weekday, {PIVOT} FROM plays GROUP BY 1"),
)
SHARES = ", ".join(
    rnd(f"count(*) FILTER (WHERE hour(time_stamp) = {h}) / count(*) * 100", 4) + f" AS h{h:02d}" for h in HOURS
)
add(
    "skip_heatmap",
    lambda t: temporal.skip_heatmap(t.plays),
    with_views("plays", f"SELECT {WEEKDAY} AS weekday, {SHARES} FROM plays WHERE reason_end = 'fwdbtn' GROUP BY 1"),
)
GRID = ", ".join(
    rnd(
        f"sum(skipped) FILTER (WHERE hour(time_stamp) = {h}) / count(*) FILTER (WHERE hour(time_stamp) = {h}) * 100", 4
    ) + f" AS h{h:02d}"
    for h in HOURS
)
add(
    "skip_rate_hour_weekday",
    lambda t: temporal.skip_rate_grid(t.plays),
    with_views("plays", f"SELECT {WEEKDAY} AS weekday, {GRID} FROM plays GROUP BY 1"),
)

SPINE = dict(
    d="SELECT CAST(time_stamp AS DATE) AS day, CAST(sum(sec_played) AS BIGINT) AS seconds FROM plays_long GROUP BY 1",
    s="SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d",
    j="SELECT s.day, coalesce(d.seconds, 0) AS seconds FROM s LEFT JOIN d ON d.day = s.day",
)
add("date_spine_left_join", lambda t: temporal.daily_seconds(t.plays_long), with_views("plays_long", "SELECT * FROM j", **SPINE))
add(
    "daily_usage_trend",
    lambda t: temporal.daily_usage_trend(t.plays_long),
    with_views(
        "plays_long",
        f"SELECT day, {rnd('seconds / 3600', 4)} AS hours, {rnd('m / 3600', 4)} AS trend FROM "
        "(SELECT *, sum(seconds) OVER w / count(seconds) OVER w AS m FROM j "
        "WINDOW w AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))",
        **SPINE,
    ),
)
add(
    "rolling_mean_rows",
    lambda t: temporal.daily_seconds(t.plays_long).transform(
        lambda d: d.select(
            "day",
            X.round_even(temporal.trailing_mean(d, "seconds", "day", 3), 4).alias("mean_3"),
            X.round_even(temporal.trailing_mean(d, "seconds", "day", 30), 4).alias("mean_30"),
        )
    ),
    with_views(
        "plays_long",
        f"SELECT day, {rnd('sum(seconds) OVER a / count(seconds) OVER a', 4)} AS mean_3, "
        f"{rnd('sum(seconds) OVER b / count(seconds) OVER b', 4)} AS mean_30 FROM j "
        "WINDOW a AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), "
        "b AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)",
        **SPINE,
    ),
)
add(
    "autoplay_reliance",
    lambda t: temporal.autoplay_reliance(t.plays_long),
    with_views(
        "plays_long",
        f"SELECT month, streams, passive, {rnd('ratio', 4)} AS ratio, "
        f"{rnd('sum(ratio) OVER w / count(ratio) OVER w', 4)} AS smooth_ratio FROM "
        "(SELECT *, passive / streams * 100 AS ratio FROM a) WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
        a=f"SELECT {MONTH_START} AS month, count(*) AS streams, count(*) FILTER (WHERE reason_start = 'trackdone') AS passive "
        "FROM plays_long GROUP BY 1",
    ),
)
add(
    "seasonal_intensity_pivot",
    lambda t: temporal.seasonal_intensity(t.plays_long),
    with_views(
        "plays_long",
        "SELECT year, artist_name, "
        + ", ".join(
            rnd(f"count(*) FILTER (WHERE season = '{s}') / {w}", 4) + f" AS {s.lower()}"
            for s, w in (("Summer", 3), ("Monsoon", 4), ("Winter", 5))
        )
        + " FROM p SEMI JOIN top USING (year, artist_name) GROUP BY 1, 2",
        p=f"SELECT {YEAR} AS year, artist_name, {SEASON} AS season FROM plays_long",
        top="SELECT * FROM (SELECT year, artist_name, row_number() OVER (PARTITION BY year ORDER BY count(*) DESC, artist_name) AS rk "
        "FROM p GROUP BY 1, 2) WHERE rk <= 5",
    ),
)
add(
    "semi_join_top_entities",
    lambda t: t.plays_long.withColumn("year", F.year("time_stamp")).join(
        temporal.rank.topn_per_group(
            temporal.rank.totals(t.plays_long, ["artist_name"], "year"), ["year"], "play_counts", ["artist_name"], 5
        ),
        ["year", "artist_name"],
        "left_semi",
    ).select("year", "artist_name", "event_id"),
    with_views(
        "plays_long",
        "SELECT year, artist_name, event_id FROM p SEMI JOIN top USING (year, artist_name)",
        p=f"SELECT {YEAR} AS year, artist_name, event_id FROM plays_long",
        top="SELECT * FROM (SELECT year, artist_name, row_number() OVER (PARTITION BY year ORDER BY count(*) DESC, artist_name) AS rk "
        "FROM p GROUP BY 1, 2) WHERE rk <= 5",
    ),
)
QUARTER = "CAST(year(ft) AS VARCHAR) || '-Q' || CAST(quarter(ft) AS VARCHAR)"
add(
    "discovery_funnel",
    lambda t: temporal.discovery_funnel(t.plays_long),
    with_views(
        "plays_long",
        f"SELECT {QUARTER} AS quarter, rs AS reason_start, count(*) AS new_artists FROM a "
        "WHERE rs IN ('clickrow', 'trackdone', 'fwdbtn') GROUP BY 1, 2",
        a="SELECT artist_name, min(time_stamp) AS ft, (list(reason_start ORDER BY time_stamp, event_id) "
        "FILTER (WHERE reason_start IS NOT NULL))[1] AS rs FROM plays_long GROUP BY 1",
    ),
)

# --- sessions ---------------------------------------------------------------------------------


def session_ctes(gap_sec, gap_from="end", view="plays"):
    begin = "time_stamp" if gap_from == "end" else "time_stamp - to_seconds(sec_played)"
    order = "PARTITION BY user_id ORDER BY time_stamp, event_id"
    return dict(
        g=f"SELECT *, epoch_us({begin}) - epoch_us(lag(time_stamp) OVER ({order})) AS gap FROM {view}",
        n=f"SELECT *, CAST(coalesce(gap > {gap_sec * 1000000}, false) AS INTEGER) AS is_new_session FROM g",
        z=f"SELECT *, CAST(sum(is_new_session) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id FROM n",
        tot="SELECT user_id, session_id, min(time_stamp) AS session_start, max(time_stamp) AS session_end, "
        "CAST(sum(sec_played) AS BIGINT) AS total_sec, count(song_name) AS songs FROM z GROUP BY 1, 2",
    )


for name, gap, origin in (("sessionize", 1800, "end"), ("sessionize_12h", HALF_DAY, "end"), ("sessionize_from_start", HALF_DAY, "start")):
    add(
        name,
        lambda t, g=gap, o=origin: sessions.sessionize(t.plays, g, o).select("user_id", "event_id", "is_new_session", "session_id"),
        with_views("plays", "SELECT user_id, event_id, is_new_session, session_id FROM z", **session_ctes(gap, origin)),
    )
for name, gap in (("marathons", 1800), ("marathons_12h", HALF_DAY)):
    add(
        name,
        lambda t, g=gap: sessions.marathons(t.plays, g),
        with_views(
            "plays",
            f"SELECT *, {rnd('total_sec / 3600', 2)} AS total_hours FROM tot ORDER BY total_sec DESC, user_id, session_id LIMIT 10",
            **session_ctes(gap),
        ),
    )
add(
    "binge_histogram",
    lambda t: sessions.binge_histogram(t.plays_long),
    with_views(
        "plays_long",
        f"SELECT CAST({rnd('total_sec / 3600', 0)} AS INTEGER) AS rounded_hours, count(*) AS sessions FROM tot WHERE total_sec >= 3600 GROUP BY 1",
        **session_ctes(900, "start", "plays_long"),
    ),
)
add(
    "session_quantiles",
    lambda t: sessions.session_quantiles(t.plays, HALF_DAY),
    with_views(
        "plays",
        "SELECT count(*) AS sessions, "
        + ", ".join(rnd(f"quantile_cont(total_sec, {p}) / 3600", 4) + f" AS p{int(p * 100)}_hours" for p in (0.5, 0.75, 0.9, 0.99))
        + " FROM tot",
        **session_ctes(HALF_DAY),
    ),
)
add(
    "silent_gap_distribution",
    lambda t: sessions.silent_gaps(t.plays, 1800),
    with_views(
        "plays",
        "SELECT gap // 3600000000 AS gap_hours, count(*) AS gaps, CAST(sum(gap // 1000000) AS BIGINT) AS gap_seconds FROM "
        "(SELECT epoch_us(session_start) - epoch_us(lag(session_end) OVER (PARTITION BY user_id ORDER BY session_id)) AS gap FROM tot) "
        "WHERE gap IS NOT NULL GROUP BY 1",
        **session_ctes(1800),
    ),
)
add(
    "longest_sessions_per_user",
    lambda t: sessions.longest_sessions_per_user(t.plays, HALF_DAY),
    with_views(
        "plays",
        "SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY total_sec DESC, session_id) AS INTEGER) AS rank "
        "FROM tot QUALIFY rank <= 3",
        **session_ctes(HALF_DAY),
    ),
)

# --- islands ----------------------------------------------------------------------------------
UNIT_SQL = {"years": YEAR, "months": ABS_MONTH, "days": f"({DATE} - DATE '1970-01-01')"}


def island_ctes(view, keys, unit):
    return dict(
        p=f"SELECT {keys}, CAST({UNIT_SQL[unit]} AS INTEGER) AS p, count(*) AS plays FROM {view} GROUP BY ALL",
        q=f"SELECT *, p - row_number() OVER (PARTITION BY {keys} ORDER BY p) AS run FROM p",
        r=f"SELECT {keys}, count(*) AS length, min(p) AS first_p, max(p) AS last_p, CAST(sum(plays) AS BIGINT) AS plays "
        f"FROM q GROUP BY {keys}, run",
    )


def month_sql(p):
    return f"make_date(CAST(({p} - 1) // 12 AS BIGINT), CAST(({p} - 1) % 12 + 1 AS BIGINT), 1)"


add(
    "artist_month_streaks",
    lambda t: islands.artist_month_streaks(t.plays_long),
    with_views(
        "plays_long",
        f"SELECT artist_name, length AS consecutive_months, {month_sql('first_p')} AS start_month, {month_sql('last_p')} AS end_month FROM r",
        **island_ctes("plays_long", "artist_name", "months"),
    ),
)
for entity in ("artist", "song"):
    for unit in ("years", "months", "days"):
        col = f"{entity}_name"
        view = "plays" if unit == "days" else "plays_long"
        add(
            f"{entity}_streak_{unit}",
            lambda t, c=col, u=unit, v=view: islands.longest_streak(getattr(t, v), c, u),
            with_views(
                view,
                f"SELECT {col}, length AS consecutive_{unit}, plays AS total_plays_in_streak FROM r "
                f"QUALIFY row_number() OVER (PARTITION BY {col} ORDER BY length DESC, plays DESC, first_p) = 1",
                **island_ctes(view, col, unit),
            ),
        )
add(
    "listening_day_streaks",
    lambda t: islands.listening_day_streaks(t.plays),
    with_views(
        "plays",
        "SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY length DESC, first_p) AS INTEGER) AS rank, "
        "length AS consecutive_days, DATE '1970-01-01' + first_p AS streak_start, DATE '1970-01-01' + last_p AS streak_end "
        "FROM r QUALIFY rank <= 10",
        **island_ctes("plays", "user_id", "days"),
    ),
)
add(
    "silent_breaks",
    lambda t: islands.silent_breaks(t.plays),
    with_views(
        "plays",
        "SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY silent_days DESC, p) AS INTEGER) AS rank, silent_days, "
        "DATE '1970-01-01' + p AS break_start, DATE '1970-01-01' + np AS break_end FROM "
        "(SELECT *, np - p - 1 AS silent_days FROM (SELECT *, lead(p) OVER (PARTITION BY user_id ORDER BY p) AS np FROM p)) "
        "WHERE silent_days > 0 QUALIFY rank <= 10",
        **island_ctes("plays", "user_id", "days"),
    ),
)
add(
    "silent_days",
    lambda t: islands.silent_days(t.plays),
    with_views(
        "plays",
        f"SELECT *, calendar_days - active_days AS silent_days, {rnd('(calendar_days - active_days) / calendar_days * 100', 1)} AS silent_share "
        "FROM (SELECT user_id, count(*) AS active_days, CAST(max(p) - min(p) + 1 AS BIGINT) AS calendar_days FROM p GROUP BY 1)",
        **island_ctes("plays", "user_id", "days"),
    ),
)
add(
    "date_difference",
    lambda t: islands.silent_dates(t.plays),
    with_views(
        "plays",
        "SELECT user_id, day FROM s EXCEPT SELECT user_id, day FROM a",
        a=f"SELECT DISTINCT user_id, {DATE} AS day FROM plays",
        s="SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM a GROUP BY user_id",
    ),
)
for unit in ("days", "months", "years"):
    view = "plays" if unit == "days" else "plays_long"
    add(
        f"artist_hiatus_{unit}",
        lambda t, u=unit, v=view: islands.hiatus(getattr(t, v), u),
        with_views(
            view,
            f"SELECT artist_name, CAST(max(gap) AS BIGINT) AS longest_silent_{unit} FROM "
            "(SELECT *, p - lag(p) OVER (PARTITION BY artist_name ORDER BY p) - 1 AS gap FROM p) WHERE gap IS NOT NULL GROUP BY 1",
            **island_ctes(view, "artist_name", unit),
        ),
    )
add(
    "ordered_categories",
    lambda t: t.plays_long.groupBy(
        X.day_name("time_stamp").alias("day_name"), X.season("time_stamp").alias("season")
    ).agg(F.count(F.lit(1)).alias("plays")).withColumns(
        {"day_position": X.ordinal(F.col("day_name"), X.DAY_NAMES), "season_position": X.ordinal(F.col("season"), X.SEASONS)}
    ),
    with_views(
        "plays_long",
        "SELECT *, CAST(list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], day_name) AS INTEGER) AS day_position, "
        "CAST(list_position(['Summer','Monsoon','Winter'], season) AS INTEGER) AS season_position FROM a",
        a=f"SELECT dayname(time_stamp) AS day_name, {SEASON} AS season, count(*) AS plays FROM plays_long GROUP BY 1, 2",
    ),
)
