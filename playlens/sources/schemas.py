"""Declared schemas. A column a source lacks becomes a typed null at read."""

RAW_PLAYS = """
ts STRING, platform STRING, ms_played BIGINT, conn_country STRING, ip_addr STRING,
master_metadata_track_name STRING, master_metadata_album_artist_name STRING,
master_metadata_album_album_name STRING, spotify_track_uri STRING,
episode_name STRING, episode_show_name STRING, spotify_episode_uri STRING,
audiobook_title STRING, audiobook_uri STRING, audiobook_chapter_uri STRING, audiobook_chapter_title STRING,
reason_start STRING, reason_end STRING, shuffle BOOLEAN, skipped BOOLEAN, offline BOOLEAN, incognito_mode BOOLEAN
"""

PLAYS = """
user_id BIGINT, event_id BIGINT, time_stamp TIMESTAMP, song_name STRING, artist_name STRING, album_name STRING,
tags ARRAY<STRING>, sec_played INT, reason_end STRING, reason_start STRING, platform STRING, shuffle INT,
offline INT, country STRING, skipped INT
"""

AUDIT = """
played_at STRING, predicted_at STRING, resolved_at STRING, track_id STRING, song_name STRING, artist_name STRING,
album_name STRING, predicted_prob DOUBLE, predicted_skip INT, risk_tier STRING, actual_played_sec DOUBLE,
total_duration_sec DOUBLE, actual_skipped INT, evaluation_result STRING, cdn_mb_saved DOUBLE, status STRING
"""

TRACK_META = "artist_name STRING, song_name STRING, genres ARRAY<STRING>, listeners BIGINT, playcount BIGINT"

RECENT_POLL = """
user_id BIGINT,
items ARRAY<STRUCT<played_at: STRING, track: STRUCT<id: STRING, name: STRING, duration_ms: BIGINT,
  artists: ARRAY<STRUCT<name: STRING>>, album: STRUCT<name: STRING>>>>
"""

PROGRESS = """
user_id BIGINT, poll_ts TIMESTAMP, track_id STRING, song_name STRING, artist_name STRING, album_name STRING,
progress_sec DOUBLE, duration_sec DOUBLE, status STRING
"""
