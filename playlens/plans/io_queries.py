"""Round trips through the readers and writers: Spark derives the files from the given tables."""

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.functions import sqlfuncs
from playlens.operators import rank, temporal
from playlens.plans.enrich_queries import RATED, lookup_ctes, rated_features
from playlens.plans.engagement_queries import FAMILY
from playlens.plans.oracle import DATE, SEASON, duration, rnd, with_views
from playlens.plans.ranking_queries import AGG
from playlens.plans.registry import add
from playlens.operators import clean
from playlens.session import scratch_path
from playlens.sources import readers, sinks


def raw_json(t):
    """Raw exports are files that hold one JSON array each: blocks of 500 plays, one file per block."""
    directory = scratch_path(t.spark, "raw")
    raw = t.raw_plays
    block = F.floor(F.col("event_id") / 500).alias("block")
    fields = [c for c in raw.columns if c not in ("user_id", "event_id")]
    arrays = raw.groupBy(block).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
    arrays.write.partitionBy("block").text(directory)
    return readers.read_raw(t.spark, directory, "part-*")


add(
    "scan_raw_json",
    lambda t: clean.clean_plays(raw_json(t)).select("time_stamp", "song_name", "artist_name", "album_name", "platform", "country", "sec_played", "skipped", "reason_start"),
    with_views(
        "raw_plays",
        "SELECT ts AS time_stamp, master_metadata_track_name AS song_name, master_metadata_album_artist_name AS artist_name, "
        f"master_metadata_album_album_name AS album_name, {FAMILY} AS platform, conn_country AS country, CAST(ms_played // 1000 AS INTEGER) AS sec_played, "
        "CAST(coalesce(reason_end = 'fwdbtn', false) AS INTEGER) AS skipped, reason_start FROM raw_plays "
        "WHERE master_metadata_track_name IS NOT NULL AND master_metadata_album_artist_name IS NOT NULL",
    ),
)


def audit_lines(t):
    """An audit log with blank and broken lines between the records."""
    path = scratch_path(t.spark, "audit")
    record = F.to_json(F.struct(F.col("played_at").cast("string").alias("played_at"), "song_name", "predicted_prob", "predicted_skip",
                                "actual_played_sec", "actual_skipped", "evaluation_result", "cdn_mb_saved", "status"))
    line = F.when(F.col("event_id") % 19 == 0, "").when(F.col("event_id") % 23 == 0, "{broken").otherwise(record)
    t.audit.select(line.alias("value")).write.text(path)
    return path


add(
    "scan_jsonl_audit",
    lambda t: readers.read_audit(t.spark, audit_lines(t)).select("song_name", "predicted_prob", "predicted_skip", "actual_skipped", "evaluation_result", "status"),
    with_views(
        "audit",
        "SELECT song_name, predicted_prob, predicted_skip, actual_skipped, evaluation_result, status FROM audit "
        "WHERE event_id % 19 <> 0 AND event_id % 23 <> 0 AND (status = 'RESOLVED' OR actual_skipped IS NOT NULL)",
    ),
)


def live_csv(t):
    path = scratch_path(t.spark, "live")
    t.plays.select("user_id", "event_id", "song_name", "sec_played", "reason_start").write.option("header", True).csv(path)
    return readers.read_live_csv(t.spark, path, "user_id BIGINT, event_id BIGINT, song_name STRING, sec_played INT, reason_start STRING")


add("scan_csv_live", live_csv, with_views("plays", "SELECT user_id, event_id, song_name, sec_played, reason_start FROM plays"))


def meta_cache(t):
    """Cache texts keyed ``artist|||song``, 50 parts per text, with an unreadable text among them."""
    p = t.table("part")
    key = F.concat_ws("|||", "p_brand", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
    value = F.struct(F.split("p_name", " ").alias("genres"), F.col("p_size").cast("bigint").alias("listeners"), F.col("p_partkey").alias("playcount"))
    texts = p.groupBy(F.floor(F.col("p_partkey") / 50)).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(key, value)))).alias("value"))
    path = scratch_path(t.spark, "cache")
    texts.select("value").write.text(path)
    p.where("p_partkey = 0").select(F.lit("{unreadable").alias("value")).write.mode("append").text(path)
    return readers.meta_from_map(t.spark.read.text(path))


add(
    "scan_meta_cache",
    lambda t: meta_cache(t).withColumn("genres", F.concat_ws(",", "genres")),
    "SELECT p_brand AS artist_name, p_name || ' ' || p_partkey AS song_name, replace(p_name, ' ', ',') AS genres, CAST(p_size AS BIGINT) AS listeners, "
    "p_partkey AS playcount FROM part",
)


def meta_records(t):
    path = scratch_path(t.spark, "records")
    t.track_meta.select("artist_name", "song_name", "genres", F.col("version").alias("playcount")).write.json(path)
    return readers.read_meta_records(t.spark, path, multi_line=False)


add(
    "scan_meta_records",
    lambda t: meta_records(t).select("artist_name", "song_name", F.size("genres").alias("n"), "playcount"),
    with_views("track_meta", "SELECT artist_name, song_name, CAST(len(genres) AS INTEGER) AS n, version AS playcount FROM track_meta"),
)


def tag_nodes(t):
    node = F.struct(F.upper("p_brand").alias("name"))
    p = t.table("part")
    listed = F.to_json(F.array(node, F.struct(F.col("p_type").alias("name")), F.struct(F.lit(None).cast("string").alias("name")), F.struct(F.col("p_name").alias("name"))))
    kind = F.col("p_partkey") % 3
    return p.select("p_partkey", F.when(kind == 0, listed).when(kind == 1, F.to_json(node)).alias("node"))


add(
    "tag_node_parse",
    lambda t: readers.top_tags(tag_nodes(t), "node", 2).select("p_partkey", F.concat_ws("|", "tags").alias("tags")),
    "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN lower(p_brand) || '|' || lower(p_type) WHEN 1 THEN lower(p_brand) ELSE '' END AS tags FROM part",
)


def stored_by_year(t):
    path = scratch_path(t.spark, "table")
    yearly = t.plays_long.select("event_id", "artist_name", "sec_played", "time_stamp", F.year("time_stamp").alias("year"))
    for _ in range(2):  # the second write replaces the first
        sinks.overwrite_table(yearly, path)
    return t.spark.read.parquet(path).where("year >= 1998").groupBy("year").agg(F.count(F.lit(1)).alias("plays"), F.sum("sec_played").alias("seconds"))


add(
    "sink_table_overwrite",
    stored_by_year,
    with_views("plays_long", "SELECT CAST(year(time_stamp) AS INTEGER) AS year, count(*) AS plays, CAST(sum(sec_played) AS BIGINT) AS seconds FROM plays_long "
               "WHERE year(time_stamp) >= 1998 GROUP BY 1"),
)


def report(t):
    """All three sections as written: their titles and how their rows look."""
    directory = scratch_path(t.spark, "report")
    sections = {
        "core rankings": {"top artists": rank.top_entities(t.plays, ["artist_name"]), "top songs": rank.top_entities(t.plays, ["song_name", "artist_name"])},
        "temporal habits": {"volume by month": temporal.volume(t.plays, "month")},
    }
    sinks.report_sections(sections, directory)

    def table(path, schema, name, count="play_counts"):
        rows = t.spark.read.schema(schema).json(f"{directory}/{path}")
        return rows.select(F.lit(path).alias("path"), F.expr(name).alias("name"), F.col(count).alias("plays"))

    artists = table("core_rankings/top_artists", "artist_name STRING, play_counts BIGINT", "artist_name")
    songs = table("core_rankings/top_songs", "song_name STRING, artist_name STRING, play_counts BIGINT", "song_name || '::' || artist_name")
    months = table("temporal_habits/volume_by_month", "period DATE, plays BIGINT", "cast(period AS string)", "plays")
    return artists.unionByName(songs).unionByName(months)


add(
    "sink_report_sections",
    report,
    with_views(
        "plays",
        f"SELECT 'core_rankings/top_artists' AS path, artist_name AS name, play_counts AS plays FROM (SELECT artist_name, {AGG} FROM plays GROUP BY 1 ORDER BY play_counts DESC, 1 LIMIT 10) "
        f"UNION ALL SELECT 'core_rankings/top_songs', song_name || '::' || artist_name, play_counts FROM (SELECT song_name, artist_name, {AGG} FROM plays GROUP BY 1, 2 ORDER BY play_counts DESC, 1, 2 LIMIT 10) "
        "UNION ALL SELECT 'temporal_habits/volume_by_month', CAST(CAST(date_trunc('month', time_stamp) AS DATE) AS VARCHAR), count(song_name) FROM plays GROUP BY 2",
    ),
)


def snapshot(t):
    path = scratch_path(t.spark, "lookup")
    sinks.lookup_snapshot(rated_features(t), path)
    kinds = [t.spark.read.parquet(f"{path}/{k}").withColumn("kind", F.lit(k)) for k in ("artist", "song")]
    return kinds[0].unionByName(kinds[1]).select("kind", "lookup_key", X.round_even("rate", 6).alias("rate"))


add(
    "sink_lookup_snapshot",
    snapshot,
    with_views("plays", f"SELECT 'artist' AS kind, lookup_key, {rnd('rate', 6)} AS rate FROM al UNION ALL SELECT 'song', lookup_key, {rnd('rate', 6)} FROM sl",
               **RATED, **lookup_ctes("artist_name", "al"), **lookup_ctes("song_name", "sl", "song_rate")),
)


def append_log(t):
    """Append the audit twice to a log that starts with its pending rows; the log keeps one row per key."""
    path = scratch_path(t.spark, "log")
    schema = "user_id BIGINT, event_id BIGINT, song_name STRING, status STRING"
    rows = t.audit.select("user_id", "event_id", "song_name", "status")
    counts = [sinks.append_new(part, path, ["event_id"], schema) for part in (rows.where("status = 'PENDING'"), rows, rows)]
    log = sinks.read_log(t.spark, path, schema)
    inserted = ", ".join(str(c[0]) for c in counts)
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("keys")).withColumn("inserted", F.lit(inserted))


add(
    "sink_jsonl_append_log",
    append_log,
    with_views("audit", "SELECT status, count(*) AS rows, count(*) AS keys, (SELECT count(*) FILTER (WHERE status = 'PENDING') || ', ' || "
               "count(*) FILTER (WHERE status <> 'PENDING') || ', 0' FROM audit) AS inserted FROM audit GROUP BY 1"),
)


def by_sql(t):
    sqlfuncs.register(t.spark)
    t.plays_long.createOrReplaceTempView("playlens_plays_long")
    return t.spark.sql(
        "SELECT to_date(time_stamp) AS day, season_of(month(time_stamp)) AS season, daypart_of(hour(time_stamp) + minute(time_stamp) / 60) AS daypart, "
        "count(*) AS plays FROM playlens_plays_long GROUP BY ALL"
    )


add(
    "sql_functions",
    by_sql,
    with_views("plays_long", f"SELECT {DATE} AS day, {SEASON} AS season, 'Midnight' AS daypart, count(*) AS plays FROM plays_long GROUP BY 1, 2"),
)
