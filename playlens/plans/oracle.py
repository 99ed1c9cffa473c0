"""SQL text shared by the DuckDB oracles: the same canonical views as `playlens.sources.tables`."""

from __future__ import annotations

import string

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_PLATFORM = (
    "CASE {0} % 7 WHEN 0 THEN 'Android OS 9 API 28' WHEN 1 THEN 'Windows 10 (10.0.19042)' "
    "WHEN 2 THEN 'iOS 14.4 (iPhone12,1)' WHEN 3 THEN 'OS X 11.2' WHEN 4 THEN 'Linux x86' "
    "WHEN 5 THEN 'web_player' ELSE '' END"
)
_START = (
    "CASE event_id % 6 WHEN 0 THEN 'clickrow' WHEN 1 THEN 'trackdone' WHEN 2 THEN 'fwdbtn' "
    "WHEN 3 THEN 'backbtn' WHEN 4 THEN 'playbtn' END"
)
_END = (
    "CASE event_type WHEN 'click' THEN 'fwdbtn' WHEN 'view' THEN 'trackdone' WHEN 'purchase' THEN 'endplay' "
    "WHEN 'error' THEN 'unexpected-exit' WHEN 'signup' THEN 'logout' END"
)
_MIX = "(l_orderkey * 31 + l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 17)"

VIEWS = {
    "plays": f"""
  SELECT e.user_id, e.event_id, e.ts AS time_stamp, CAST(p.p_partkey AS VARCHAR) AS song_name,
         p.p_brand || '/' || p.p_type AS artist_name, p.p_type AS album_name,
         string_split(p.p_name, ' ') AS tags, CAST(trunc(e.value) AS INTEGER) AS sec_played,
         {_END} AS reason_end, {_START} AS reason_start, {_PLATFORM.format('e.user_id')} AS platform,
         CAST(event_id % 3 = 0 AS INTEGER) AS shuffle, CAST(event_id % 7 = 0 AS INTEGER) AS offline,
         n.n_name AS country, CAST(event_type = 'click' AS INTEGER) AS skipped
  FROM (SELECT *, {_K} AS k FROM events) e JOIN part p ON p.p_partkey = e.k
  LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25""",
    "plays_long": f"""
  SELECT o_custkey % 40 AS user_id, o_orderkey AS event_id, o_orderdate AS time_stamp,
         CAST(o_custkey AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS song_name,
         CAST(o_custkey AS VARCHAR) AS artist_name,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) || '-' || o_orderstatus END AS album_name,
         [lower(o_orderstatus), lower(o_orderpriority)] AS tags,
         CAST(trunc(o_totalprice) AS INTEGER) AS sec_played,
         CASE o_orderstatus WHEN 'F' THEN 'fwdbtn' WHEN 'O' THEN 'trackdone' WHEN 'P' THEN 'endplay' END AS reason_end,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'clickrow' WHEN '2-HIGH' THEN 'trackdone'
              WHEN '3-MEDIUM' THEN 'fwdbtn' WHEN '5-LOW' THEN 'backbtn' END AS reason_start,
         {_PLATFORM.format('o_custkey')} AS platform,
         CAST(o_orderkey % 3 = 0 AS INTEGER) AS shuffle, CAST(o_orderkey % 7 = 0 AS INTEGER) AS offline,
         CAST(NULL AS VARCHAR) AS country, CAST(o_orderstatus = 'F' AS INTEGER) AS skipped
  FROM orders""",
    "raw_plays": f"""
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, {_PLATFORM.format('user_id')} AS platform,
         CAST(trunc(value * 1000) AS BIGINT) AS ms_played, 'IN' AS conn_country, '10.0.0.1' AS ip_addr,
         CASE WHEN k % 10 <> 9 THEN CAST(k AS VARCHAR) END AS master_metadata_track_name,
         CASE WHEN k % 20 <> 8 THEN 'a' || CAST(k % 30 AS VARCHAR) END AS master_metadata_album_artist_name,
         'b' || CAST(k % 15 AS VARCHAR) AS master_metadata_album_album_name,
         CASE WHEN k % 10 = 9 THEN 'episode' END AS episode_name, CAST(NULL AS VARCHAR) AS audiobook_title,
         {_START} AS reason_start, {_END} AS reason_end, event_id % 3 = 0 AS shuffle,
         CASE WHEN event_id % 11 <> 0 THEN event_id % 7 = 0 END AS offline, user_id, event_id
  FROM (SELECT *, {_K} AS k FROM events)""",
    "track_meta": """
  SELECT p_brand || '/' || p_type AS artist_name, CAST(p_partkey % 100 AS VARCHAR) AS song_name,
         CASE WHEN p_partkey % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE string_split(p_name, ' ') END AS genres,
         p_partkey AS version
  FROM part""",
    "artist_meta": """
  SELECT p_brand || '/' || p_type AS artist_name, list_sort(list(DISTINCT lower(p_type))) AS genres
  FROM part WHERE p_size % 2 = 0 GROUP BY 1""",
    "scored": f"""
  SELECT l_orderkey AS event_id, CAST(l_returnflag = 'R' AS INTEGER) AS label,
         ({_MIX} % 701 + CAST(l_returnflag = 'R' AS INTEGER) * 299) / 1000 AS champion,
         ({_MIX} % 503 + CAST(l_returnflag = 'R' AS INTEGER) * 400 + 97) / 1000 AS high_recall
  FROM lineitem""",
    "scored_long": f"""
  SELECT event_id, label, 'champion' AS model, champion AS score FROM scored
  UNION ALL SELECT event_id, label, 'high_recall' AS model, high_recall AS score FROM scored""",
    "recent_plays": """
  SELECT user_id, event_id, make_timestamp(1704067200000000 + (epoch_us(time_stamp) - 1704067200000000) // 100) AS played_at,
         song_name || '::' || artist_name AS track_id,
         song_name, artist_name, album_name, 10.0::DOUBLE + CAST(song_name AS INTEGER) * 5 AS duration_sec
  FROM plays""",
    "progress": f"""
  SELECT user_id, event_id, make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 100) AS poll_ts,
         CAST({_K} // 20 AS VARCHAR) AS track_id, value AS progress_sec, 5.0::DOUBLE + {_K} AS duration_sec,
         CASE WHEN event_type = 'error' THEN 'IDLE' ELSE 'ACTIVE' END AS status
  FROM events""",
    "audit": """
  SELECT user_id, event_id, played_at, song_name, predicted_prob, predicted_skip,
         CASE WHEN NOT pending THEN value END AS actual_played_sec,
         CASE WHEN NOT pending THEN skipped END AS actual_skipped,
         CASE WHEN pending THEN NULL WHEN predicted_skip = 1 AND skipped = 1 THEN 'TRUE_POSITIVE'
              WHEN predicted_skip = 0 AND skipped = 0 THEN 'TRUE_NEGATIVE'
              WHEN predicted_skip = 1 THEN 'FALSE_POSITIVE' ELSE 'FALSE_NEGATIVE' END AS evaluation_result,
         CASE WHEN NOT pending AND predicted_skip = 1 AND skipped = 1 AND value < 45 THEN 1.0::DOUBLE
              ELSE 0.0::DOUBLE END AS cdn_mb_saved,
         CASE WHEN pending THEN 'PENDING' ELSE 'RESOLVED' END AS status
  FROM (SELECT user_id, event_id, ts AS played_at, json_extract_string(props, '$.k') AS song_name, value,
               (event_id * 37 % 1000) / 1000 AS predicted_prob,
               CAST((event_id * 37 % 1000) / 1000 >= 0.45 AS INTEGER) AS predicted_skip,
               event_id % 10 = 0 AS pending, CAST(event_type = 'click' AS INTEGER) AS skipped
        FROM events)""",
    "predictions": """
  SELECT user_id, event_id, ts AS made_at, json_extract_string(props, '$.k') AS song_name, 'a' AS artist_name,
         (event_id * 37 % 1000) / 1000 AS prob, CAST(event_id % 50 = 0 AS INTEGER) AS flagged
  FROM events WHERE event_type IN ('view', 'purchase', 'signup')""",
    "outcomes": """
  SELECT user_id, event_id, ts AS made_at, json_extract_string(props, '$.k') AS song_name, 'a' AS artist_name,
         value AS listen_sec, value + 60 AS total_sec, CAST(event_type = 'click' AS INTEGER) AS was_skipped
  FROM events WHERE event_type IN ('click', 'error')""",
}
_NEEDS = {"scored_long": ["scored"], "recent_plays": ["plays"]}


def with_views(views: str, body: str, **more: str) -> str:
    """``WITH <views>, <more> body``; ``views`` is a blank-separated list of names in `VIEWS`."""
    names: list[str] = []
    for v in views.split():
        names += [n for n in [*_NEEDS.get(v, []), v] if n not in names]
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return (f"WITH {', '.join(ctes)}\n" if ctes else "") + body


def rnd(x: str, digits: int) -> str:
    """Half-even rounding by scale and unscale, as `exprs.round_even`."""
    s = f"{10**digits}::DOUBLE"
    return f"(round_even(CAST(({x}) AS DOUBLE) * {s}, 0) / {s})"


def duration(x: str) -> str:
    s = f"CAST({x} AS BIGINT)"
    return string.Template(
        "CASE WHEN $s < 60 THEN $s || 's' "
        "WHEN $s < 3600 THEN ($s // 60) || 'm ' || ($s % 60) || 's' "
        "WHEN $s < 86400 THEN ($s // 3600) || 'h ' || ($s // 60 % 60) || 'm ' || ($s % 60) || 's' "
        "WHEN $s < 2592000 THEN ($s // 86400) || 'd ' || ($s // 3600 % 24) || 'm' "
        "WHEN $s < 31104000 THEN ($s // 2592000) || 'mo ' || ($s // 86400 % 30) || 'd ' || ($s // 3600 % 24) || 'h' "
        "ELSE ($s // 31104000) || 'y ' || ($s // 2592000 % 12) || 'm ' || ($s // 86400 % 30) || 'd' END"
    ).substitute(s=s)


WEEKDAY = "(CAST(isodow(time_stamp) AS INTEGER) - 1)"
YEAR = "CAST(year(time_stamp) AS INTEGER)"
MONTH = "CAST(month(time_stamp) AS INTEGER)"
HOUR = "CAST(hour(time_stamp) AS INTEGER)"
MONTH_START = "CAST(date_trunc('month', time_stamp) AS DATE)"
DATE = "CAST(time_stamp AS DATE)"
SEASON = (
    "CASE WHEN month(time_stamp) BETWEEN 3 AND 5 THEN 'Summer' "
    "WHEN month(time_stamp) BETWEEN 6 AND 9 THEN 'Monsoon' ELSE 'Winter' END"
)
ABS_MONTH = "CAST(year(time_stamp) * 12 + month(time_stamp) AS INTEGER)"
TOKEN = (
    "(upper(substr(split_part(coalesce(platform, 'None'), ' ', 1), 1, 1)) || "
    "lower(substr(split_part(coalesce(platform, 'None'), ' ', 1), 2)))"
)
OUTCOME = "CASE WHEN reason_end = 'fwdbtn' THEN 'Skipped' WHEN reason_end = 'trackdone' THEN 'Completed' ELSE 'Other' END"
