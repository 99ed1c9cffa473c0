import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from playlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Lets a test lower the hot-key limit for its own body."""
    yield lambda rows: spark.conf.set("playlens.hot.rows", str(rows))
    spark.conf.unset("playlens.hot.rows")


@pytest.fixture
def tables(spark):
    from playlens.sources.tables import Tables

    return Tables(spark, SMALL)


PLAY_SCHEMA = (
    "user_id bigint, event_id bigint, time_stamp timestamp, song_name string, artist_name string, album_name string, "
    "tags array<string>, sec_played int, reason_end string, reason_start string, platform string, shuffle int, skipped int"
)


@pytest.fixture
def make_plays(spark):
    """Plays from (user, id, 'YYYY-MM-DD HH:MM:SS', skipped) and overrides."""
    import datetime as dt

    def build(rows, **fixed):
        out = []
        for user, event, at, skipped, *more in rows:
            r = {
                "song_name": f"s{event}", "artist_name": "a", "album_name": None, "tags": [], "sec_played": 30,
                "reason_start": "trackdone", "platform": "windows", "shuffle": 0, **fixed, **(more[0] if more else {}),
            }
            out.append((
                user, event, dt.datetime.fromisoformat(at), r["song_name"], r["artist_name"], r["album_name"], r["tags"],
                r["sec_played"], "fwdbtn" if skipped else "trackdone", r["reason_start"], r["platform"], r["shuffle"], skipped,
            ))
        return spark.createDataFrame(out, PLAY_SCHEMA)

    return build
