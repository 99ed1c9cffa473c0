"""Metadata joins, tag imputation and rate lookups."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import enrich, features
from playlens.plans.feature_queries import KEYS, prior_view, rate_sql, skipped_view
from playlens.plans.oracle import rnd, with_views
from playlens.plans.registry import add
from playlens.session import materialize

META = "plays track_meta artist_meta"
ONE = dict(
    one="SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY artist_name, song_name ORDER BY version) AS rn FROM track_meta) WHERE rn = 1"
)
CASCADE = dict(
    **ONE,
    c="SELECT p.*, CASE WHEN len(o.genres) > 0 THEN o.genres WHEN len(a.genres) > 0 THEN a.genres ELSE CAST([] AS VARCHAR[]) END AS genres, "
    "CASE WHEN len(o.genres) > 0 THEN 'track' WHEN len(a.genres) > 0 THEN 'artist' ELSE 'none' END AS genre_source "
    "FROM plays p LEFT JOIN one o USING (artist_name, song_name) LEFT JOIN artist_meta a USING (artist_name)",
)
TOP = dict(
    **CASCADE,
    k="SELECT artist_name, tag, count(*) AS n FROM (SELECT artist_name, unnest(list_distinct(genres)) AS tag FROM c) "
    "WHERE artist_name IN (SELECT artist_name FROM c WHERE len(genres) = 0) GROUP BY 1, 2",
    tt="SELECT artist_name, list(tag ORDER BY rk) AS top_tags FROM (SELECT *, row_number() OVER (PARTITION BY artist_name ORDER BY n DESC, tag) AS rk FROM k) "
    "WHERE rk <= 3 GROUP BY 1",
    f="SELECT c.* EXCLUDE (genres, genre_source), CASE WHEN len(genres) > 0 THEN genres ELSE coalesce(top_tags, CAST([] AS VARCHAR[])) END AS genres, "
    "CASE WHEN len(genres) > 0 THEN genre_source WHEN len(top_tags) > 0 THEN 'artist_top' ELSE 'none' END AS genre_source "
    "FROM c LEFT JOIN tt USING (artist_name)",
)
TEXT = "array_to_string(genres, ', ') AS genres"


def text(df, *columns):
    return df.select("event_id", *columns, F.concat_ws(", ", "genres").alias("genres"))


def cascade(t):
    return enrich.genre_cascade(t.plays, t.track_meta, t.artist_meta)


add(
    "enrich_left_join_dedup",
    lambda t: enrich.enrich_left(t.plays, t.track_meta).select("event_id", F.concat_ws(", ", "track_genres").alias("genres")),
    with_views(META, "SELECT event_id, coalesce(array_to_string(o.genres, ', '), '') AS genres FROM plays LEFT JOIN one o USING (artist_name, song_name)", **ONE),
)
add("genre_cascade", lambda t: text(cascade(t), "genre_source"), with_views(META, f"SELECT event_id, genre_source, {TEXT} FROM c", **CASCADE))
OK_TAGS = "SELECT tag FROM (SELECT unnest(genres) AS tag FROM one) GROUP BY 1 HAVING count(*) >= 10"
add(
    "frequent_tag_filter",
    lambda t: enrich.frequent_tag_filter(t.track_meta, t.artist_meta).select("artist_name", "song_name", F.concat_ws(", ", "genres").alias("genres")),
    with_views(
        META,
        "SELECT artist_name, song_name, CASE WHEN t.g <> '' THEN t.g ELSE coalesce(a.g, '') END AS genres FROM t LEFT JOIN a USING (artist_name)",
        **ONE,
        ok=OK_TAGS,
        t="SELECT artist_name, song_name, coalesce(string_agg(tag, ', ' ORDER BY i) FILTER (WHERE tag IN (SELECT tag FROM ok)), '') AS g FROM "
        "(SELECT artist_name, song_name, unnest(CASE WHEN len(genres) = 0 THEN [NULL] ELSE genres END) AS tag, "
        "generate_subscripts(CASE WHEN len(genres) = 0 THEN [NULL] ELSE genres END, 1) AS i FROM one) GROUP BY 1, 2",
        a="SELECT artist_name, string_agg(tag, ', ' ORDER BY i) AS g FROM "
        "(SELECT artist_name, unnest(genres) AS tag, generate_subscripts(genres, 1) AS i FROM artist_meta) WHERE tag IN (SELECT tag FROM ok) GROUP BY 1",
    ),
)
add(
    "frequent_tags",
    lambda t: enrich.frequent_tags(t.track_meta),
    with_views(META, "SELECT tag, count(*) AS tracks FROM (SELECT unnest(genres) AS tag FROM one) GROUP BY 1 HAVING count(*) >= 10", **ONE),
)
add(
    "artist_top3_imputation",
    lambda t: text(enrich.impute_artist_tags(cascade(t)), "genre_source"),
    with_views(META, f"SELECT event_id, genre_source, {TEXT} FROM f", **TOP),
)
add(
    "unknown_tag_flag",
    lambda t: text(enrich.flag_unknown(enrich.impute_artist_tags(cascade(t)))),
    with_views(META, "SELECT event_id, CASE WHEN len(genres) = 0 THEN 'unknown' ELSE array_to_string(genres, ', ') END AS genres FROM f", **TOP),
)
add(
    "missing_metadata_worklist",
    lambda t: enrich.missing_tracks(t.plays, t.track_meta.where(enrich.tagged("genres"))),
    with_views(META, "SELECT DISTINCT artist_name, song_name FROM plays ANTI JOIN (SELECT artist_name, song_name FROM track_meta WHERE len(genres) > 0) USING (artist_name, song_name)"),
)
add(
    "missing_artist_worklist",
    lambda t: enrich.missing_artists(t.track_meta, t.artist_meta),
    with_views(META, "SELECT DISTINCT artist_name FROM track_meta WHERE len(genres) = 0 AND artist_name NOT IN (SELECT artist_name FROM artist_meta)"),
)
add(
    "genre_coverage",
    lambda t: enrich.genre_coverage(enrich.impute_artist_tags(cascade(t))),
    with_views(META, f"SELECT genre_source, count(*) AS plays, {rnd('count(*) / (SELECT count(*) FROM f) * 100', 2)} AS share FROM f GROUP BY 1", **TOP),
)
add("distinct_tracks", lambda t: t.plays.select("artist_name", "song_name").distinct(), with_views("plays", "SELECT DISTINCT artist_name, song_name FROM plays"))

# --- rate lookups: names in two spellings, so that normalised keys collide -----------------------
SPELL = "CASE WHEN event_id % 2 = 0 THEN upper(artist_name) ELSE ' ' || lower(artist_name) END"


def rated_features(t):
    """Artist and song rates before each play, with the artist in two spellings; stored, as both lookups read it."""
    rates = features.target_rates(t.plays, ["artist", "song"], ["user_id", "event_id", "time_stamp", "artist_name", "song_name"])
    return materialize(rates.withColumn("artist_name", F.expr(SPELL)), "rates")


RATED = dict(
    b=skipped_view("plays"),
    p=prior_view(),
    r=f"SELECT time_stamp, event_id, song_name, {SPELL} AS artist_name, {rate_sql(KEYS['artist'])} AS rate, {rate_sql(KEYS['song'])} AS song_rate FROM p",
)


def lookup_ctes(name, table, rate="rate"):
    return {
        f"{table}_raw": f"SELECT {name} AS nm, arg_max({rate}, (time_stamp, event_id)) AS rate, max((time_stamp, event_id)) AS seen FROM r GROUP BY 1",
        table: f"SELECT lower(trim(nm)) AS lookup_key, arg_min(rate, seen) AS rate FROM {table}_raw GROUP BY 1",
    }


def artist_rates(t):
    """Read once: nothing is stored."""
    rates = features.target_rates(t.plays, ["artist"], ["event_id", "time_stamp", "artist_name"])
    return enrich.latest_rates(rates.withColumn("artist_name", F.expr(SPELL)), "artist_name", "artist_smoothed_skip_rate")


add(
    "latest_rate_lookup",
    lambda t: artist_rates(t).select("lookup_key", X.round_even("rate", 6).alias("rate")),
    with_views("plays", f"SELECT lookup_key, {rnd('rate', 6)} AS rate FROM al", **RATED, **lookup_ctes("artist_name", "al")),
)


def lookups(t):
    known = rated_features(t)
    return enrich.latest_rates(known, "artist_name", "artist_smoothed_skip_rate"), enrich.latest_rates(known, "song_name", "song_smoothed_skip_rate")


LOOKUPS = {**RATED, **lookup_ctes("artist_name", "al"), **lookup_ctes("song_name", "sl", "song_rate")}


def with_new_names(df):
    """Some rows name an artist, or a song, that nobody has played yet."""
    e = F.col("event_id")
    return df.withColumns(
        {n: F.when(e % k == 0, F.concat(F.lit("new "), F.col(n))).otherwise(F.col(n)) for n, k in (("artist_name", 9), ("song_name", 4))}
    )


JOINED = (
    "LEFT JOIN al ON al.lookup_key = lower(trim(CASE WHEN x.event_id % 9 = 0 THEN 'new ' || x.artist_name ELSE x.artist_name END)) "
    "LEFT JOIN sl ON sl.lookup_key = lower(trim(CASE WHEN x.event_id % 4 = 0 THEN 'new ' || x.song_name ELSE x.song_name END))"
)
add(
    "lookup_with_fallback",
    lambda t: enrich.with_rates(with_new_names(t.plays), *lookups(t)).select(
        "event_id",
        "is_cold_start_artist",
        X.round_even("artist_smoothed_skip_rate", 6).alias("artist_rate"),
        X.round_even("song_smoothed_skip_rate", 6).alias("song_rate"),
    ),
    with_views(
        "plays",
        "SELECT event_id, CAST(al.lookup_key IS NULL AS INTEGER) AS is_cold_start_artist, "
        f"{rnd('coalesce(al.rate, 0.104)', 6)} AS artist_rate, {rnd('coalesce(sl.rate, al.rate, 0.104)', 6)} AS song_rate FROM plays x {JOINED}",
        **LOOKUPS,
    ),
)
add(
    "static_risk_map",
    lambda t: t.plays_long.groupBy("reason_start").agg(F.count(F.lit(1)).alias("plays")).withColumn("risk", X.reason_risk("reason_start")),
    with_views(
        "plays_long",
        "SELECT reason_start, count(*) AS plays, CAST(CASE reason_start WHEN 'trackdone' THEN 0.025 WHEN 'clickrow' THEN 0.120 "
        "WHEN 'fwdbtn' THEN 0.604 WHEN 'backbtn' THEN 0.400 WHEN 'playbtn' THEN 0.050 ELSE 0.104 END AS DOUBLE) AS risk FROM plays_long GROUP BY 1",
    ),
)
add(
    "anti_join_new_events",
    lambda t: enrich.new_events(t.plays.select("user_id", "song_name"), t.plays.where("skipped = 1").select("user_id", "song_name"), ["user_id", "song_name"]),
    with_views("plays", "SELECT DISTINCT user_id, song_name FROM plays EXCEPT SELECT user_id, song_name FROM plays WHERE skipped = 1"),
)
