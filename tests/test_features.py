"""Causality, tie rules and literal values of the per-play features."""

import random

from pyspark.sql import functions as F

from playlens.operators import features
from tests.conftest import PLAY_SCHEMA

NAMES = ["Coldplay", "Radiohead", "Daft Punk", "Coldplay", "Radiohead"]


def synth(make_plays, flipped=()):
    rows = []
    for i in range(50):
        minute = 3 * i
        skip = int(i % 3 == 0) ^ int(i in flipped)
        rows.append((1, i, f"2025-01-01 {minute // 60:02d}:{minute % 60:02d}:00", skip, {
            "artist_name": NAMES[i % 5], "song_name": f"Track_{i}", "platform": "windows" if i % 2 == 0 else "android",
            "reason_start": "fwdbtn" if skip else "trackdone",
        }))
    return make_plays(rows)


def matrix(plays):
    columns = ["user_id", "event_id", *features.FEATURE_COLUMNS, "rolling_global_skip_rate"]
    return {r["event_id"]: r for r in features.feature_matrix(plays).select(*columns).collect()}


def test_first_play_equals_prior_and_label_never_leaks(make_plays):
    before, after = matrix(synth(make_plays)), matrix(synth(make_plays, {0}))
    assert before[0]["artist_smoothed_skip_rate"] == before[0]["rolling_global_skip_rate"] == 0.0
    assert before[0] == after[0]
    assert before[1]["rolling_global_skip_rate"] != after[1]["rolling_global_skip_rate"]


def test_flipping_a_label_changes_no_earlier_play(make_plays):
    before, after = matrix(synth(make_plays)), matrix(synth(make_plays, {20}))
    reason = "reason_start_smoothed_skip_rate"  # the fixture derives the start reason from the label itself
    for i in range(21):
        a, b = before[i].asDict(), after[i].asDict()
        if i == 20:
            a.pop(reason), b.pop(reason)
        assert a == b
    assert any(before[i] != after[i] for i in range(21, 50))


def test_three_minute_window_literals(make_plays):
    plays = make_plays([(1, 0, "2025-01-01 10:00:00", 1), (1, 1, "2025-01-01 10:01:00", 1), (1, 2, "2025-01-01 10:02:00", 0), (1, 3, "2025-01-01 10:10:00", 1)])
    got = {r["event_id"]: r["w"] for r in features.rolling_skips(plays, {"w": 180}).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 0}


def brute(rows, window):
    """(event, skips in (t-W, t] earlier in order, last skip strictly before t, streak) by definition."""
    out = {}
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[1]))
        for i, (_, event, t, _) in enumerate(mine):
            earlier = mine[:i]
            hits = sum(s for _, _, u, s in earlier if u > t - window)
            last = max((u for _, _, u, s in mine if s and u < t), default=None)
            streak = 0
            for _, _, _, s in reversed(earlier):
                if s:
                    break
                streak += 1
            out[event] = (hits, last, streak)
    return out


def tie_heavy(spark, n=600, seed=7):
    """Times on a 60 s grid; one of four users owns more than half of the rows, many at one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.6 else rng.randint(2, 4)
        t = 1_700_000_000 + (0 if rng.random() < 0.3 else 60 * rng.randint(0, 200))
        rows.append((user, i, t, rng.randint(0, 1)))
    raw = spark.createDataFrame(rows, "user_id bigint, event_id bigint, t bigint, skipped int")
    name = F.concat(F.lit("n"), (F.col("event_id") % 7).cast("string"))
    plays = raw.select(
        "user_id", "event_id", F.timestamp_seconds("t").alias("time_stamp"), name.alias("song_name"),
        F.concat(F.lit("a"), (F.col("event_id") % 3).cast("string")).alias("artist_name"),
        F.when(F.col("event_id") % 4 != 0, F.lit("b")).alias("album_name"), F.array(F.lit("x"), name, F.lit("x")).alias("tags"),
        F.lit(30).alias("sec_played"), F.when(F.col("skipped") == 1, "fwdbtn").otherwise("trackdone").alias("reason_end"),
        F.lit(None).cast("string").alias("reason_start"), F.lit("windows").alias("platform"), F.lit(0).alias("shuffle"), "skipped",
    )
    assert plays.columns == [c.split()[0] for c in PLAY_SCHEMA.split(", ")]
    return rows, plays


def check_ties(spark):
    rows, plays = tie_heavy(spark)
    expected = brute(rows, 180)
    got = features.rolling_skips(plays, {"w": 180}).join(features.last_skip(plays), ["user_id", "event_id"]).join(
        features.momentum_features(plays), ["user_id", "event_id"]
    )
    found = {
        r["event_id"]: (r["w"], r["last"], r["consecutive_listens_streak"])
        for r in got.withColumn("last", F.unix_seconds("last_skip_time")).collect()
    }
    assert found == expected


def test_tied_times_by_definition(spark):
    check_ties(spark)


def test_tied_times_by_definition_with_hot_user(spark, hot):
    hot(100)
    check_ties(spark)


def test_multitag_counts_repeated_tags_twice(make_plays):
    plays = make_plays([(1, 0, "2025-01-01 10:00:00", 1, {"tags": ["Rock", "rock", "pop"]}), (1, 1, "2025-01-01 11:00:00", 0, {"tags": ["rock", "pop"]})])
    got = {r["event_id"]: r["genre_multitag_skip_rate"] for r in features.target_encode_multitag(plays).collect()}
    prior = 1.0
    assert abs(got[1] - ((2 + 20 * prior) / 22 + (1 + 20 * prior) / 21) / 2) < 1e-12
    assert got[0] == 0.0


def test_smoothing_weight_is_a_parameter(make_plays):
    plays = make_plays([(1, 0, "2025-01-01 10:00:00", 1), (1, 1, "2025-01-01 11:00:00", 0, {"artist_name": "b"})])
    got = {r["event_id"]: r["artist_smoothed_skip_rate"] for r in features.target_encode(plays, "artist", weight=10).collect()}
    assert got == {0: 0.0, 1: 1.0}
