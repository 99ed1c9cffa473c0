"""Column rules on literal values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import clean, quality


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "seconds, text",
    [
        (0, "0s"), (59, "59s"), (60, "1m 0s"), (3599, "59m 59s"), (3600, "1h 0m 0s"), (86399, "23h 59m 59s"),
        (86400, "1d 0m"), (90000, "1d 1m"), (30 * 86400, "1mo 0d 0h"), (360 * 86400, "1y 0m 0d"), (400 * 86400, "1y 1m 10d"),
    ],
)
def test_duration_text(spark, seconds, text):
    assert one(spark, X.duration_text, seconds, "bigint") == text


@pytest.mark.parametrize(
    "raw, family, coarse",
    [
        ("Android OS 9", "android", "android"), ("Windows 10", "windows", "windows"), ("iOS 14 (iPhone12,1)", "ios", "ios"),
        ("web_player iPad", "ios", "other"), ("OSX 11", "macos", "other"), ("Linux ios", "ios", "linux"), ("web_player", "web", "other"),
        ("Partner unknown", "unknown", "other"), ("  ", "unknown", "other"), (None, "unknown", "other"), ("toaster", "other", "other"),
        ("Darwin", "macos", "other"), ("Macintosh", "macos", "mac"),
    ],
)
def test_platforms(spark, raw, family, coarse):
    assert one(spark, X.platform_family, raw, "string") == family
    assert one(spark, X.platform_coarse, raw, "string") == coarse


@pytest.mark.parametrize("hour, part", [(5, "Morning"), (11.99, "Morning"), (12, "Afternoon"), (17, "Evening"), (19.49, "Evening"),
                                        (19.5, "Night"), (23.99, "Night"), (0, "Midnight"), (4.99, "Midnight")])
def test_daypart(spark, hour, part):
    assert one(spark, X.daypart, float(hour), "double") == part


@pytest.mark.parametrize("month, season", [(2, "Winter"), (3, "Summer"), (5, "Summer"), (6, "Monsoon"), (9, "Monsoon"), (10, "Winter"), (12, "Winter")])
def test_season(spark, month, season):
    assert one(spark, X.season, dt.datetime(2024, month, 1), "timestamp") == season


@pytest.mark.parametrize("value, digits, expected", [(0.5, 0, 0.0), (1.5, 0, 2.0), (2.5, 0, 2.0), (0.25, 1, 0.2), (0.35, 1, 0.4), (-2.5, 0, -2.0), (2.675, 2, 2.68)])
def test_round_even_like_numpy(spark, value, digits, expected):
    import numpy as np

    got = one(spark, lambda c: X.round_even(c, digits), value, "double")
    assert got == float(np.round(value, digits))
    assert abs(got - expected) < 0.011


@pytest.mark.parametrize("ms, sec", [(0, 0), (999, 0), (1000, 1), (1999, 1)])
def test_ms_truncate(spark, ms, sec):
    assert one(spark, X.ms_to_seconds, ms, "bigint") == sec


@pytest.mark.parametrize("prob, tier", [(0.9, "CRITICAL"), (0.776, "CRITICAL"), (0.5, "HIGH"), (0.45, "HIGH"), (0.35, "MODERATE"), (0.1, "SAFE")])
def test_tier(spark, prob, tier):
    assert one(spark, X.risk_tier_4, prob, "double") == tier


@pytest.mark.parametrize("duration, rule, cutoff", [(240.0, "duration", 230.0), (18.0, "duration", 10.0), (15.0, "duration", 15.0), (12.0, "flat30", 30.0)])
def test_cutoff(spark, duration, rule, cutoff):
    assert one(spark, lambda c: X.completion_cutoff(c, rule), duration, "double") == cutoff


def test_reason_risk_default(spark):
    assert one(spark, X.reason_risk, "FwdBtn", "string") == 0.604
    assert one(spark, X.reason_risk, None, "string") == 0.104


def test_localize(spark):
    got = one(spark, lambda c: X.localize(c, "Asia/Kolkata"), dt.datetime(2024, 1, 1, 20, 0), "timestamp")
    assert got == dt.datetime(2024, 1, 2, 1, 30)


def test_clean_plays_without_optional_columns(spark):
    df = spark.createDataFrame([("s", None, 1999), ("s", "a", 1999)], "master_metadata_track_name string, master_metadata_album_artist_name string, ms_played bigint")
    row = clean.clean_plays(df).collect()
    assert [r.asDict() for r in row] == [{"song_name": "s", "artist_name": "a", "skipped": 0, "sec_played": 1}]


def test_negative_request_is_rejected_with_reason(spark):
    df = spark.createDataFrame([("x", -5), ("y", 1), (None, 0)], "song_name string, skips_last_3m int")
    ok, bad = quality.split_valid(df, ["song_name"], ["skips_last_3m"])
    assert [r["song_name"] for r in ok.collect()] == ["y"]
    assert {r["song_name"]: r["reasons"] for r in bad.collect()} == {"x": ["negative skips_last_3m"], None: ["missing song_name"]}


def test_sql_functions_equal_the_column_rules(spark):
    from playlens.functions import exprs as X
    from playlens.functions import sqlfuncs

    assert "format_duration" in sqlfuncs.register(spark)
    seconds = [0, 59, 60, 3599, 3600, 86399, 86400, 2591999, 2592000, 31103999, 31104000, 99999999]
    frame = spark.createDataFrame([(s, s % 86400 / 3600.0) for s in seconds + [5 * 3600, 12 * 3600, 17 * 3600, 70200, 43199]], "s bigint, h double")
    out = frame.selectExpr("*", "format_duration(s) AS a", "daypart_of(h) AS c").withColumn("b", X.duration_text("s")).withColumn("d", X.daypart(frame["h"]))
    rows = out.collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in rows) and {r["c"] for r in rows} >= {"Morning", "Afternoon", "Evening", "Night", "Midnight"}
