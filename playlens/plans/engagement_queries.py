"""Skip, shuffle, reason, platform and country queries."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import engagement, platforms
from playlens.plans.oracle import HOUR, MONTH, OUTCOME, TOKEN, WEEKDAY, YEAR, rnd, with_views
from playlens.plans.registry import add

N = "(SELECT count(*) FROM plays)"


def skip_rate_sql(entity, minimum, view="plays"):
    return with_views(
        view,
        f"SELECT *, {rnd('skip_count / total_plays * 100', 1)} AS skip_percentage FROM (SELECT {entity}, "
        f"CAST(sum(skipped) AS BIGINT) AS skip_count, count(*) AS total_plays FROM {view} GROUP BY 1) WHERE total_plays >= {minimum}",
    )


add("skip_rate_artist", lambda t: engagement.skip_rate(t.plays, "artist_name"), skip_rate_sql("artist_name", 15))
add("skip_rate_song", lambda t: engagement.skip_rate(t.plays, "song_name", 10), skip_rate_sql("song_name", 10))
add(
    "having_min_support",
    lambda t: engagement.skip_rate(t.plays_long, "artist_name", 12),
    skip_rate_sql("artist_name", 12, "plays_long"),
)

BUCKETS = {
    "hour": (lambda: F.hour("time_stamp"), HOUR, "plays"),
    "weekday": (lambda: F.weekday("time_stamp"), WEEKDAY, "plays"),
    "month": (lambda: F.month("time_stamp"), MONTH, "plays_long"),
    "year": (lambda: F.year("time_stamp"), YEAR, "plays_long"),
    "shuffle": (lambda: F.col("shuffle"), "shuffle", "plays"),
}
for flag, stem in (("skipped", "skip_rate"), ("shuffle", "shuffle_rate")):
    for bucket, (expr, sql, view) in BUCKETS.items():
        if flag == bucket:
            continue
        add(
            f"{stem}_by_{bucket}",
            lambda t, f=flag, b=bucket, e=expr, v=view: engagement.flag_rate_by(getattr(t, v), f, **{b: e()}),
            with_views(
                view,
                f"SELECT *, {rnd('hits / plays * 100', 4)} AS percentage FROM (SELECT {sql} AS {bucket}, "
                f"CAST(sum({flag}) AS BIGINT) AS hits, count(*) AS plays FROM {view} GROUP BY 1)",
            ),
        )
add(
    "shuffle_weekend_skip",
    lambda t: engagement.shuffle_weekend_skip(t.plays),
    with_views(
        "plays",
        f"SELECT *, {rnd('shuffled / plays * 100', 4)} AS shuffle_share, {rnd('skipped / plays * 100', 4)} AS skip_rate FROM "
        f"(SELECT CAST({WEEKDAY} >= 5 AS INTEGER) AS weekend, count(*) AS plays, CAST(sum(shuffle) AS BIGINT) AS shuffled, "
        "CAST(sum(skipped) AS BIGINT) AS skipped FROM plays GROUP BY 1)",
    ),
)


def share_sql(expr, label, digits):
    return with_views(
        "plays",
        f"SELECT {expr} AS {label}, count(*) AS plays, {rnd(f'count(*) / {N} * 100', digits)} AS percentage "
        f"FROM plays WHERE {expr} IS NOT NULL GROUP BY 1",
    )


for column in ("reason_start", "reason_end"):
    add(f"{column}_share", lambda t, c=column: engagement.value_share(t.plays, c), share_sql(column, column, 2))
add("country_share", lambda t: engagement.value_share(t.plays, "country"), share_sql("country", "country", 2))
add(
    "broadcast_totals",
    lambda t: engagement.value_share(t.plays, "song_name", 6),
    share_sql("song_name", "song_name", 6),
)

ENDS = ["fwdbtn", "trackdone", "endplay", "unexpected-exit", "logout"]
add(
    "lifecycle_matrix",
    lambda t: engagement.lifecycle_matrix(t.plays, ENDS),
    with_views(
        "plays",
        "SELECT reason_start, "
        + ", ".join(rnd(f"count(*) FILTER (WHERE reason_end = '{e}') / count(*) * 100", 4) + f' AS "{e}"' for e in ENDS)
        + " FROM plays WHERE reason_start IS NOT NULL AND reason_end IS NOT NULL GROUP BY 1",
    ),
)
FLOWS = dict(
    st=f"SELECT 'Device: ' || {TOKEN} AS a, 'Start: ' || coalesce(reason_start, 'None') AS b, "
    "'End: ' || coalesce(reason_end, 'None') AS c FROM plays",
    e="SELECT a AS source, b AS target, count(*) AS plays FROM st GROUP BY 1, 2 UNION ALL "
    "SELECT b, c, count(*) FROM st GROUP BY 1, 2",
    k=f"SELECT * FROM e WHERE plays >= {N} * 0.01",
    nd="SELECT node, CAST(row_number() OVER (ORDER BY node) - 1 AS INTEGER) AS node_id FROM "
    "(SELECT source AS node FROM k UNION SELECT target FROM k)",
)
add(
    "lifecycle_flows",
    lambda t: engagement.lifecycle_flows(t.plays),
    with_views(
        "plays",
        "SELECT k.source, k.target, k.plays, s.node_id AS source_id, d.node_id AS target_id FROM k "
        "JOIN nd s ON s.node = k.source JOIN nd d ON d.node = k.target",
        **FLOWS,
    ),
)
add(
    "distinct_nodes",
    lambda t: engagement.distinct_nodes(engagement.lifecycle_flows(t.plays)),
    with_views("plays", "SELECT * FROM nd", **FLOWS),
)
add(
    "attention_span_year",
    lambda t: engagement.attention_span(t.plays_long, 200000),
    with_views(
        "plays_long",
        f"SELECT *, {rnd('total_sec / skip_count', 4)} AS avg_seconds_before_skip FROM (SELECT {YEAR} AS year, "
        "CAST(sum(sec_played) AS BIGINT) AS total_sec, count(*) AS skip_count FROM plays_long "
        "WHERE reason_end = 'fwdbtn' AND sec_played <= 200000 GROUP BY 1)",
    ),
)
add(
    "bounded_filter",
    lambda t: t.plays.where((F.col("reason_end") == X.SKIP_REASON) & (F.col("sec_played") <= 630)).select("event_id", "sec_played"),
    with_views("plays", "SELECT event_id, sec_played FROM plays WHERE reason_end = 'fwdbtn' AND sec_played <= 630"),
)
for name, minimum in (("quickest_skipped_artists", 15), ("quickest_skipped_artists_min5", 5)):
    add(
        name,
        lambda t, m=minimum: engagement.quickest_skipped(t.plays, m),
        with_views(
            "plays",
            "SELECT artist_name, CAST(median(sec_played) AS DOUBLE) AS median_skip_sec, count(*) AS total_skips FROM plays "
            f"WHERE skipped = 1 GROUP BY 1 HAVING count(*) >= {minimum}",
        ),
    )
add(
    "attention_shift_artist",
    lambda t: engagement.attention_shift(t.plays_long, 2),
    with_views(
        "plays_long",
        f"SELECT artist_name, year, play_counts, {rnd('m', 4)} AS avg_time_before_skip, "
        f"{rnd('max(m) OVER w - min(m) OVER w', 4)} AS drastic_change FROM a WINDOW w AS (PARTITION BY artist_name)",
        a=f"SELECT artist_name, {YEAR} AS year, count(sec_played) AS play_counts, "
        "sum(sec_played) FILTER (WHERE skipped = 1) / nullif(count(*) FILTER (WHERE skipped = 1), 0) AS m "
        "FROM plays_long GROUP BY 1, 2 HAVING count(sec_played) >= 2",
    ),
)
add(
    "skip_cdf",
    lambda t: engagement.skip_cdf(t.plays),
    with_views(
        "plays",
        f"SELECT sec_played, skips, CAST(c AS BIGINT) AS at_most, {rnd('c / (SELECT sum(skips) FROM a)', 6)} AS cdf FROM "
        "(SELECT *, sum(skips) OVER (ORDER BY sec_played) AS c FROM a)",
        a="SELECT sec_played, count(*) AS skips FROM plays WHERE reason_end = 'fwdbtn' GROUP BY 1",
    ),
)
add(
    "skip_cdf_thresholds",
    lambda t: engagement.skip_thresholds(t.plays),
    with_views(
        "plays",
        "SELECT count(*) AS skips, "
        + ", ".join(rnd(f"count(*) FILTER (WHERE sec_played <= {c}) / greatest(count(*), 1)", 6) + f" AS within_{c}s" for c in (5, 15, 30))
        + " FROM plays WHERE reason_end = 'fwdbtn'",
    ),
)
add(
    "bandwidth_by_outcome",
    lambda t: engagement.bandwidth_by_outcome(t.plays),
    with_views(
        "plays",
        f"SELECT {OUTCOME} AS outcome, count(*) AS tracks, {rnd('count(*) * 4.3::DOUBLE / 1024', 4)} AS total_gb FROM plays GROUP BY 1",
    ),
)
LUMP = (
    "SELECT CASE WHEN n >= {n} * 0.02 THEN reason_start ELSE 'Other' END AS reason_start, CAST(sum(n) AS BIGINT) AS plays "
    "FROM (SELECT reason_start, count(*) AS n FROM plays WHERE reason_start IS NOT NULL GROUP BY 1) GROUP BY 1"
).format(n=N)
add("ui_trigger_breakdown", lambda t: engagement.ui_trigger_breakdown(t.plays), with_views("plays", LUMP))
add(
    "rare_value_lumping",
    lambda t: engagement.lump_rare(t.plays, "artist_name", 0.01),
    with_views("plays", LUMP.replace("reason_start", "artist_name").replace("0.02", "0.01")),
)
add(
    "control_mode_by_hour",
    lambda t: engagement.control_mode_by_hour(t.plays),
    with_views(
        "plays",
        f"SELECT {HOUR} AS hour, "
        + rnd("count(*) FILTER (WHERE reason_start IS DISTINCT FROM 'trackdone') / count(*) * 100", 4)
        + " AS active, "
        + rnd("count(*) FILTER (WHERE reason_start = 'trackdone') / count(*) * 100", 4)
        + " AS passive FROM plays GROUP BY 1",
    ),
)
for name, minimum in (("one_hit_wonders", 1), ("one_hit_wonders_min15", 15)):
    add(
        name,
        lambda t, m=minimum: engagement.one_hit_wonders(t.plays, m),
        with_views(
            "plays",
            "SELECT artist_name, min(song_name) AS the_one_hit, 1 AS unique_songs, count(*) AS total_plays FROM plays "
            f"GROUP BY 1 HAVING count(DISTINCT song_name) = 1 AND count(*) >= {minimum}",
        ),
    )

# --- platform -----------------------------------------------------------------------------------
add(
    "platform_share",
    lambda t: platforms.platform_share(t.plays),
    with_views(
        "plays",
        f"SELECT {TOKEN} AS platform, count(song_name) AS plays, CAST(sum(sec_played) AS BIGINT) AS total_seconds, "
        f"{rnd('sum(sec_played) / 3600', 1)} AS hours, {rnd(f'count(song_name) / {N} * 100', 1)} AS percentage FROM plays GROUP BY 1",
    ),
)
add(
    "platform_hours",
    lambda t: platforms.platform_hours(t.plays),
    with_views("plays", f"SELECT {TOKEN} AS platform, {rnd('sum(sec_played) / 3600', 4)} AS total_hours FROM plays GROUP BY 1"),
)
add(
    "platform_outcome_ratio",
    lambda t: platforms.platform_outcome_ratio(t.plays),
    with_views(
        "plays",
        f"SELECT {TOKEN} AS platform, "
        + ", ".join(rnd(f"count(*) FILTER (WHERE {OUTCOME} = '{o}') / count(*) * 100", 4) + f" AS {o.lower()}" for o in platforms.OUTCOMES)
        + " FROM plays GROUP BY 1",
    ),
)
FAMILY = (
    "CASE WHEN trim(coalesce(platform, '')) = '' THEN 'unknown' WHEN platform ILIKE '%android%' THEN 'android' "
    "WHEN platform ILIKE '%window%' THEN 'windows' WHEN platform ILIKE '%ios%' OR platform ILIKE '%iphone%' OR platform ILIKE '%ipad%' THEN 'ios' "
    "WHEN platform ILIKE '%mac%' OR platform ILIKE '%darwin%' OR platform ILIKE '%osx%' THEN 'macos' "
    "WHEN platform ILIKE '%linux%' THEN 'linux' WHEN platform ILIKE '%web%' THEN 'web' "
    "WHEN platform ILIKE '%unknown%' THEN 'unknown' ELSE 'other' END"
)
add(
    "platform_engagement",
    lambda t: platforms.platform_engagement(t.plays),
    with_views(
        "plays",
        f"SELECT {FAMILY} AS platform, count(*) AS plays, {rnd('sum(sec_played) / count(*)', 4)} AS mean_seconds, "
        f"{rnd('sum(skipped) / count(*) * 100', 4)} AS skip_percentage FROM plays GROUP BY 1",
    ),
)
add(
    "offline_share",
    lambda t: platforms.offline_share(t.plays),
    with_views(
        "plays",
        f"SELECT CASE offline WHEN 0 THEN 'Online' WHEN 1 THEN 'Offline' END AS mode, count(*) AS plays, "
        f"{rnd(f'count(*) / {N} * 100', 4)} AS percentage FROM plays WHERE offline IN (0, 1) GROUP BY 1",
    ),
)
