"""Rankings over artists, songs, albums and tags."""

from pyspark.sql import functions as F

from playlens.operators import rank
from playlens.plans.oracle import ABS_MONTH, DATE, MONTH, MONTH_START, SEASON, YEAR, duration, with_views
from playlens.plans.registry import add

PLAYS, SECONDS = rank.PLAYS, rank.SECONDS
PERIOD_SQL = {
    "year": {"year": YEAR},
    "month": {"period": MONTH_START},
    "day": {"period": DATE},
    "month_of_year": {"month": MONTH},
    "season": {"season": SEASON},
    "season_year": {"year": YEAR, "season": SEASON},
}
AGG = f"count(song_name) AS {PLAYS}, CAST(sum(sec_played) AS BIGINT) AS {SECONDS}"


def _known(entity):
    return " AND ".join(f"{e} IS NOT NULL" for e in entity)


def top_sql(view, entity, by=PLAYS, n=10):
    keys = ", ".join(entity)
    return with_views(
        view,
        f"SELECT {keys}, {PLAYS}, {SECONDS}, {duration(SECONDS)} AS total_time FROM t "
        f"ORDER BY {by} DESC, {keys} LIMIT {n}",
        t=f"SELECT {keys}, {AGG} FROM {view} WHERE {_known(entity)} GROUP BY {keys}",
    )


def period_sql(view, entity, period, by=PLAYS, n=10):
    cols = PERIOD_SQL[period]
    keys, group = ", ".join(entity), ", ".join(cols)
    select = ", ".join(f"{x} AS {c}" for c, x in cols.items())
    return with_views(
        view,
        f"SELECT {group}, {keys}, {PLAYS}, {SECONDS}, CAST(rk AS INTEGER) AS rank, {duration(SECONDS)} AS total_time "
        f"FROM r WHERE rk <= {n}",
        t=f"SELECT {select}, {keys}, {AGG} FROM {view} WHERE {_known(entity)} GROUP BY ALL",
        r=f"SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {by} DESC, {keys}) AS rk FROM t",
    )


def add_top(name, view, entity, by=PLAYS):
    add(name, lambda t: rank.top_entities(getattr(t, view), entity, by), top_sql(view, entity, by))


def add_period(name, view, entity, period, by=PLAYS, n=10):
    add(
        name,
        lambda t: rank.top_per_period(getattr(t, view), entity, period, by, n),
        period_sql(view, entity, period, by, n),
    )


ARTIST, SONG, ALBUM = ["artist_name"], ["song_name", "artist_name"], ["album_name", "artist_name"]
for entity, cols in (("artist", ARTIST), ("song", SONG), ("album", ALBUM)):
    add_top(f"rank_{entity}_alltime_plays", "plays", cols)
    add_top(f"rank_{entity}_alltime_time", "plays", cols, SECONDS)

add_period("rank_artist_year_plays", "plays_long", ARTIST, "year")
add_period("rank_artist_year_time", "plays_long", ARTIST, "year", SECONDS)
add_period("rank_artist_month", "plays_long", ARTIST, "month", n=3)
add_period("rank_artist_month_time", "plays_long", ARTIST, "month", SECONDS, 3)
add_period("rank_artist_day", "plays", ARTIST, "day", n=3)
add_period("rank_artist_day_time", "plays", ARTIST, "day", SECONDS, 3)
add_period("rank_artist_season", "plays_long", ARTIST, "season", n=3)
add_period("rank_artist_season_time", "plays_long", ARTIST, "season", SECONDS, 3)
add_period("rank_artist_season_year", "plays_long", ARTIST, "season_year")
add_period("rank_artist_season_year_time", "plays_long", ARTIST, "season_year", SECONDS, 3)
add_period("rank_song_year", "plays_long", SONG, "year")
add_period("rank_song_month", "plays_long", SONG, "month", n=3)
add_period("rank_song_day", "plays", SONG, "day", n=3)
add_period("rank_song_season_year", "plays_long", SONG, "season_year", n=3)
add_period("rank_album_year", "plays_long", ALBUM, "year", n=3)
add_period("rank_album_month", "plays_long", ALBUM, "month", n=3)
add_period("rank_album_month_of_year", "plays_long", ALBUM, "month_of_year", n=1)
add_period("rank_album_day", "plays", ALBUM, "day", n=3)
add_period("rank_album_season_year", "plays_long", ALBUM, "season_year", n=3)
add_period("top3_artists_per_year", "plays_long", ARTIST, "year", n=3)

add(
    "obsession_24h",
    lambda t: rank.obsession(t.plays),
    with_views(
        "plays",
        f"SELECT {DATE} AS period, song_name, artist_name, {AGG} FROM plays GROUP BY ALL "
        f"ORDER BY {PLAYS} DESC, period, song_name, artist_name LIMIT 10",
    ),
)

TAGS = "SELECT *, unnest(list_distinct(tags)) AS tag FROM {0}"
TAG_AGG = "CAST(sum(sec_played) AS BIGINT) AS total_seconds, count(*) AS total_plays"
add(
    "genre_listened_alltime",
    lambda t: rank.genre_listened(t.plays),
    with_views(
        "plays",
        f"SELECT *, {duration('total_seconds')} AS total_time FROM (SELECT tag, {TAG_AGG} FROM x GROUP BY tag)",
        x=TAGS.format("plays"),
    ),
)


def genre_period_sql(view, period, agg, metric, source):
    cols = PERIOD_SQL[period]
    group = ", ".join(cols)
    select = ", ".join(f"{x} AS {c}" for c, x in cols.items())
    columns = "total_seconds, total_plays" if metric == "total_seconds" else metric
    return with_views(
        view,
        f"SELECT {group}, tag, {columns}, CAST(rk AS INTEGER) AS rank FROM r WHERE rk = 1",
        **source,
        g=f"SELECT {select}, tag, {agg} FROM x GROUP BY ALL",
        r=f"SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {metric} DESC, tag) AS rk FROM g",
    )


for period, view in (
    ("year", "plays_long"), ("month_of_year", "plays_long"), ("month", "plays_long"),
    ("day", "plays"), ("season_year", "plays_long"),
):
    add(
        f"genre_listened_{period}",
        lambda t, p=period, v=view: rank.genre_listened(getattr(t, v), p),
        genre_period_sql(view, period, TAG_AGG, "total_seconds", {"x": TAGS.format(view)}),
    )

FIRST = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY song_name ORDER BY time_stamp, event_id) AS rn "
    "FROM {0}) WHERE rn = 1"
)
add(
    "genre_explored_alltime",
    lambda t: rank.genre_explored(t.plays_long),
    with_views(
        "plays_long",
        "SELECT tag, count(*) AS songs_explored FROM x GROUP BY tag",
        f=FIRST.format("plays_long"),
        x=TAGS.format("f"),
    ),
)
for period in ("year", "month_of_year", "month"):
    add(
        f"genre_explored_{period}",
        lambda t, p=period: rank.genre_explored(t.plays_long, p),
        genre_period_sql(
            "plays_long", period, "count(*) AS songs_explored", "songs_explored",
            {"f": FIRST.format("plays_long"), "x": TAGS.format("f")},
        ),
    )

add(
    "topk_global",
    lambda t: rank.topk(rank.totals(t.plays, ARTIST), SECONDS, ARTIST, 10),
    with_views(
        "plays",
        f"SELECT artist_name, {AGG} FROM plays GROUP BY artist_name ORDER BY {SECONDS} DESC, artist_name LIMIT 10",
    ),
)
add(
    "topk_nlargest",
    lambda t: rank.topn_per_group(rank.totals(t.plays_long, ARTIST, "year"), ["year"], SECONDS, ARTIST, 5),
    with_views(
        "plays_long",
        f"SELECT year, artist_name, {PLAYS}, {SECONDS}, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 5",
        t=f"SELECT {YEAR} AS year, artist_name, {AGG} FROM plays_long GROUP BY ALL",
        r=f"SELECT *, row_number() OVER (PARTITION BY year ORDER BY {SECONDS} DESC, artist_name) AS rk FROM t",
    ),
)
add(
    "topn_per_group",
    lambda t: rank.topn_per_group(rank.totals(t.plays, SONG, "day"), ["period"], PLAYS, SONG, 5),
    with_views(
        "plays",
        f"SELECT period, song_name, artist_name, {PLAYS}, {SECONDS}, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 5",
        t=f"SELECT {DATE} AS period, song_name, artist_name, {AGG} FROM plays GROUP BY ALL",
        r=f"SELECT *, row_number() OVER (PARTITION BY period ORDER BY {PLAYS} DESC, song_name, artist_name) AS rk FROM t",
    ),
)
add(
    "rank_year_artist_month_index",
    lambda t: rank.totals(t.plays_long, ARTIST, "month").withColumn(
        "abs_month", F.year("period") * 12 + F.month("period")
    ),
    with_views(
        "plays_long",
        f"SELECT {MONTH_START} AS period, artist_name, {AGG}, {ABS_MONTH} AS abs_month FROM plays_long GROUP BY ALL",
    ),
)
