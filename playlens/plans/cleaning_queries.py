"""Scans, cleaning steps, column rules and quality checks."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import clean, quality
from playlens.plans.engagement_queries import FAMILY
from playlens.plans.oracle import HOUR, MONTH, OUTCOME, SEASON, TOKEN, WEEKDAY, YEAR, duration, rnd, with_views
from playlens.plans.registry import add
from playlens.session import scratch_path
from playlens.sources import readers, sinks

ID = "user_id, event_id"

# --- scans --------------------------------------------------------------------------------------
add("scan_table", lambda t: t.table("events").select("event_id", "user_id", "event_type", "value"), "SELECT event_id, user_id, event_type, value FROM events")
add(
    "scan_parquet_common_columns",
    lambda t: readers.common_columns(t.table("orders"), ["o_orderkey", "o_custkey", "o_missing", "o_totalprice"]),
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
)
add(
    "scan_filtered_history",
    lambda t: readers.filtered_history(t.table("orders"), "o_orderdate", 1997, "2000-09-24").select("o_orderkey", "o_orderdate"),
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-09-24'",
)


def by_year(t):
    """The history table as the sink lays it out, and only the years asked for."""
    path = scratch_path(t.spark, "history")
    sinks.overwrite_table(t.table("orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year")), path)
    return readers.filtered_history(t.spark.read.parquet(path), "o_orderdate", 1997, "2000-09-24", "year").select("o_orderkey", "o_orderdate")


add(
    "scan_filtered_years",
    by_year,
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-09-24'",
)
add(
    "union_files",
    lambda t: readers.union_sources(
        [t.raw_plays.where("event_id % 2 = 0"), t.raw_plays.where("event_id % 2 = 1").drop("conn_country")]
    ).select("event_id", "conn_country", "ms_played"),
    with_views("raw_plays", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN conn_country END AS conn_country, ms_played FROM raw_plays"),
)

# --- raw log to plays ---------------------------------------------------------------------------
add("label_skip", lambda t: clean.label_skip(t.raw_plays).select("event_id", "reason_end", "skipped"),
    with_views("raw_plays", "SELECT event_id, reason_end, CAST(coalesce(reason_end = 'fwdbtn', false) AS INTEGER) AS skipped FROM raw_plays"))
add("ms_to_seconds", lambda t: clean.seconds_from_ms(t.raw_plays).select("event_id", "sec_played"),
    with_views("raw_plays", "SELECT event_id, CAST(ms_played // 1000 AS INTEGER) AS sec_played FROM raw_plays"))
RENAMED = (
    "master_metadata_track_name AS song_name, master_metadata_album_artist_name AS artist_name, "
    "master_metadata_album_album_name AS album_name, ts AS time_stamp, conn_country AS country"
)
NEW = ["event_id", "song_name", "artist_name", "album_name", "time_stamp", "country"]
add("rename_canonical", lambda t: clean.rename_canonical(t.raw_plays).select(*NEW),
    with_views("raw_plays", f"SELECT event_id, {RENAMED} FROM raw_plays"))
add("drop_non_music", lambda t: clean.drop_non_music(clean.rename_canonical(t.raw_plays)).select("event_id", "song_name", "artist_name"),
    with_views("raw_plays", f"SELECT event_id, song_name, artist_name FROM (SELECT event_id, {RENAMED} FROM raw_plays) "
               "WHERE song_name IS NOT NULL AND artist_name IS NOT NULL"))
add("drop_private_columns", lambda t: clean.drop_private(t.raw_plays),
    with_views("raw_plays", "SELECT * EXCLUDE (ip_addr, episode_name, audiobook_title) FROM raw_plays"))
add("drop_all_null_columns", lambda t: clean.drop_all_null_columns(t.raw_plays),
    with_views("raw_plays", "SELECT * EXCLUDE (audiobook_title) FROM raw_plays"))
add("clean_plays", lambda t: clean.clean_plays(t.raw_plays),
    with_views(
        "raw_plays",
        f"SELECT event_id, user_id, {RENAMED}, {FAMILY} AS platform, CAST(ms_played // 1000 AS INTEGER) AS sec_played, "
        "reason_start, reason_end, shuffle, offline, CAST(coalesce(reason_end = 'fwdbtn', false) AS INTEGER) AS skipped "
        "FROM raw_plays WHERE master_metadata_track_name IS NOT NULL AND master_metadata_album_artist_name IS NOT NULL",
    ))

# --- column rules -------------------------------------------------------------------------------
P = "plays"


def add_rule(name, columns, sql_columns, view=P):
    add(name, lambda t: getattr(t, view).select("event_id", *columns()), with_views(view, f"SELECT event_id, {sql_columns} FROM {view}"))


add_rule("normalize_platform", lambda: ["platform", X.platform_family("platform").alias("family")], f"platform, {FAMILY} AS family")
COARSE = (
    "CASE WHEN platform ILIKE '%android%' THEN 'android' WHEN platform ILIKE '%windows%' THEN 'windows' "
    "WHEN platform ILIKE '%linux%' THEN 'linux' WHEN platform ILIKE '%ios%' OR platform ILIKE '%iphone%' THEN 'ios' "
    "WHEN platform ILIKE '%mac%' THEN 'mac' ELSE 'other' END"
)
add_rule("normalize_platform_simple", lambda: [X.platform_coarse("platform").alias("family")], f"{COARSE} AS family")
add_rule("platform_first_token", lambda: [X.platform_token("platform").alias("token")], f"{TOKEN} AS token")
add(
    "localize_timestamp",
    lambda t: clean.parse_time(t.raw_plays, "ts", "Asia/Kolkata").select("event_id", F.col("ts").cast("string").alias("local")),
    with_views("raw_plays", "SELECT event_id, strftime(CAST(rtrim(replace(ts, 'T', ' '), 'Z') AS TIMESTAMP) + INTERVAL 330 MINUTE, "
               "'%Y-%m-%d %H:%M:%S') AS local FROM raw_plays"),
)
add(
    "calendar_fields",
    lambda t: clean.calendar_fields(t.plays).select(
        "event_id", "year", "quarter_label", "month", "day_of_month", "hour_of_day", "day_of_week", "day_name",
        X.round_even("decimal_hour", 6).alias("decimal_hour"),
    ),
    with_views(
        P,
        f"SELECT event_id, {YEAR} AS year, CAST(year(time_stamp) AS VARCHAR) || '-Q' || quarter(time_stamp) AS quarter_label, {MONTH} AS month, "
        f"CAST(day(time_stamp) AS INTEGER) AS day_of_month, {HOUR} AS hour_of_day, {WEEKDAY} AS day_of_week, dayname(time_stamp) AS day_name, "
        f"{rnd('hour(time_stamp) + minute(time_stamp) / 60', 6)} AS decimal_hour FROM plays",
    ),
)
add_rule(
    "cyclic_hour",
    lambda: [X.round_even(X.hour_sin(F.hour("time_stamp")), 6).alias("hour_sin"), X.round_even(X.hour_cos(F.hour("time_stamp")), 6).alias("hour_cos")],
    f"{rnd('sin(2 * pi() * hour(time_stamp) / 24)', 6)} AS hour_sin, {rnd('cos(2 * pi() * hour(time_stamp) / 24)', 6)} AS hour_cos",
)
add_rule("season_bucket", lambda: [X.season("time_stamp").alias("season")], f"{SEASON} AS season", "plays_long")
add_rule(
    "daypart_bucket",
    lambda: [X.daypart(X.decimal_hour("time_stamp")).alias("daypart")],
    "CASE WHEN hour(time_stamp) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(time_stamp) BETWEEN 12 AND 16 THEN 'Afternoon' "
    "WHEN hour(time_stamp) BETWEEN 17 AND 18 OR (hour(time_stamp) = 19 AND minute(time_stamp) < 30) THEN 'Evening' "
    "WHEN hour(time_stamp) >= 19 THEN 'Night' ELSE 'Midnight' END AS daypart",
)
SCALE = "CAST(sec_played AS BIGINT) * (CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 40 WHEN 2 THEN 3000 WHEN 3 THEN 90000 ELSE 900000 END)"
add(
    "format_duration",
    lambda t: t.plays.withColumn("s", F.expr(SCALE)).select("event_id", "s", X.duration_text("s").alias("text")),
    with_views(P, f"SELECT event_id, s, {duration('s')} AS text FROM (SELECT event_id, {SCALE} AS s FROM plays)"),
)
add_rule("outcome_class", lambda: [X.outcome().alias("outcome")], f"{OUTCOME} AS outcome")
add_rule("control_mode", lambda: [X.control_mode().alias("mode")], "CASE WHEN reason_start = 'trackdone' THEN 'Passive' ELSE 'Active' END AS mode")
add(
    "offline_label",
    lambda t: t.raw_plays.select("event_id", X.offline_label("offline").alias("mode")).where("mode IS NOT NULL"),
    with_views("raw_plays", "SELECT event_id, CASE WHEN offline THEN 'Offline' ELSE 'Online' END AS mode FROM raw_plays WHERE offline IS NOT NULL"),
)
add(
    "flag_fill_cast",
    lambda t: clean.flags_to_int(t.raw_plays, ["shuffle", "offline"]).select("event_id", "shuffle", "offline"),
    with_views("raw_plays", "SELECT event_id, CAST(shuffle AS INTEGER) AS shuffle, coalesce(CAST(offline AS INTEGER), 0) AS offline FROM raw_plays"),
)
add(
    "exact_dedup",
    lambda t: clean.exact_dedup(t.plays.select("user_id", "song_name", "skipped")),
    with_views(P, "SELECT DISTINCT user_id, song_name, skipped FROM plays"),
)
add(
    "platform_flags",
    lambda t: clean.platform_flags(clean.standardize_platform(t.plays)).select(
        "event_id", "platform_android", "platform_windows", "platform_linux"
    ),
    with_views(P, "SELECT event_id, " + ", ".join(f"CAST(f = '{n}' AS INTEGER) AS platform_{n}" for n in ("android", "windows", "linux"))
               + f" FROM (SELECT event_id, {FAMILY} AS f FROM plays)"),
)
add(
    "null_key_sentinel",
    lambda t: clean.sentinel_keys(t.plays_long).select("event_id", "album_key", "reason_key", "genre_key"),
    with_views("plays_long", "SELECT event_id, coalesce(album_name, 'unknown') AS album_key, coalesce(reason_start, 'unknown') AS reason_key, "
               "lower(trim(tags[1])) AS genre_key FROM plays_long"),
)
add_rule("reason_risk_map", lambda: ["reason_start", X.reason_risk("reason_start").alias("risk")],
         "reason_start, CAST(CASE reason_start WHEN 'trackdone' THEN 0.025 WHEN 'clickrow' THEN 0.120 WHEN 'fwdbtn' THEN 0.604 "
         "WHEN 'backbtn' THEN 0.400 WHEN 'playbtn' THEN 0.050 ELSE 0.104 END AS DOUBLE) AS risk")
add(
    "tag_prefix_strip_and_join",
    lambda t: clean.tags_to_text(t.plays.withColumn("tags", F.transform("tags", lambda x: F.concat(F.lit("genre_"), x)))).select("event_id", "tags"),
    with_views(P, "SELECT event_id, array_to_string(tags, ', ') AS tags FROM plays"),
)
add(
    "tag_text_split",
    lambda t: clean.text_to_tags(clean.tags_to_text(t.plays)).select("event_id", F.size("tags").alias("n"), F.element_at("tags", 1).alias("first_tag")),
    with_views(P, "SELECT event_id, CAST(len(tags) AS INTEGER) AS n, tags[1] AS first_tag FROM plays"),
)
add(
    "drop_wide_indicator_columns",
    lambda t: clean.drop_wide_indicators(
        t.plays.select("event_id", F.lit(1).alias("genre_rock"), F.lit(0).alias("genre_pop"), F.lit(0.5).alias("genre_smoothed_skip_rate"))
    ),
    with_views(P, "SELECT event_id, 0.5::DOUBLE AS genre_smoothed_skip_rate FROM plays"),
)

# --- quality --------------------------------------------------------------------------------------
NUM = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"]


def plan_sql(c):
    d = f"CAST({c} AS DOUBLE)"
    return (
        f"SELECT '{c}' AS column_name, min({d}) AS min_value, max({d}) AS max_value, count(*) - count({c}) AS nulls, "
        f"count(*) FILTER (WHERE {d} <> floor({d})) AS fractional FROM lineitem"
    )


add(
    "schema_compaction",
    lambda t: quality.compaction_plan(t.table("lineitem").select(*NUM)),
    "SELECT *, CASE WHEN fractional > 0 OR min_value IS NULL THEN 'double' WHEN min_value >= -128 AND max_value < 128 THEN 'tinyint' "
    "WHEN min_value >= -32768 AND max_value < 32768 THEN 'smallint' WHEN min_value >= -2147483648 AND max_value < 2147483648 THEN 'int' "
    "ELSE 'bigint' END AS target_type FROM (" + " UNION ALL ".join(plan_sql(c) for c in NUM) + ")",
)
add(
    "schema_compacted",
    lambda t: quality.compact(t.table("lineitem").select("l_linenumber", "l_quantity", "l_extendedprice")),
    "SELECT CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS TINYINT) AS l_quantity, l_extendedprice FROM lineitem",
)
REQUIRED, CHECKED = ["master_metadata_track_name", "master_metadata_album_artist_name"], ["ms_played", "shifted"]
BAD = (
    "list_filter([CASE WHEN trim(coalesce(master_metadata_track_name, '')) = '' THEN 'missing master_metadata_track_name' END, "
    "CASE WHEN trim(coalesce(master_metadata_album_artist_name, '')) = '' THEN 'missing master_metadata_album_artist_name' END, "
    "CASE WHEN ms_played < 0 THEN 'negative ms_played' END, CASE WHEN ms_played - 5000 < 0 THEN 'negative shifted' END], lambda x: x IS NOT NULL)"
)
add(
    "validate_rows",
    lambda t: quality.split_valid(t.raw_plays.withColumn("shifted", F.col("ms_played") - 5000), REQUIRED, CHECKED)[1].select(
        "event_id", F.concat_ws("; ", "reasons").alias("reasons")
    ),
    with_views("raw_plays", f"SELECT event_id, array_to_string(r, '; ') AS reasons FROM (SELECT event_id, {BAD} AS r FROM raw_plays) WHERE len(r) > 0"),
)
add(
    "validate_rows_accepted",
    lambda t: quality.split_valid(t.raw_plays.withColumn("shifted", F.col("ms_played") - 5000), REQUIRED, CHECKED)[0].select("event_id", "ms_played"),
    with_views("raw_plays", f"SELECT event_id, ms_played FROM raw_plays WHERE len({BAD}) = 0"),
)
