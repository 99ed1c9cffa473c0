"""Replay, audit, policy, gates: golden sequences and numbers."""

import datetime as dt

import pytest

from playlens.operators import audit, evaluate, policy, replay
from playlens.operators.models import FEATURE_COLUMNS
from playlens.sources import sinks


def recent(spark, *times, duration=240.0):
    rows = [(1, i, dt.datetime.fromisoformat(f"2026-01-01 {t}"), f"s{i}", "a", duration) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "user_id bigint, event_id bigint, played_at timestamp, song_name string, artist_name string, duration_sec double")


def rates(spark, *pairs):
    return spark.createDataFrame(list(pairs), "lookup_key string, rate double")


def test_short_gap_is_a_skip_and_played_is_capped(spark):
    got = replay.infer_outcome(recent(spark, "12:00:00", "12:00:25", "12:04:30")).orderBy("event_id").collect()
    assert [(r["actual_skipped"], r["actual_played_sec"]) for r in got] == [(0, 240.0), (1, 25.0), (0, 240.0)]


def test_idle_break_starts_a_clean_session(spark):
    out = replay.session_replay_features(recent(spark, "12:00:00", "12:00:25", "12:20:30"), rates(spark, ("a", 0.15)), rates(spark, ("s0", 0.12)))
    got = {r["event_id"]: r for r in out.collect()}
    assert got[1]["is_session_start"] == 0 and got[1]["actual_skipped"] == 1
    last = got[2]
    assert (last["is_session_start"], last["actual_skipped"], last["previous_song_skipped"], last["skips_last_15m"]) == (1, 0, 0, 0)
    assert last["seconds_since_last_skip"] == 10000.0
    assert got[0]["song_smoothed_skip_rate"] == 0.12 and got[1]["song_smoothed_skip_rate"] == 0.15
    assert set(FEATURE_COLUMNS) <= set(out.columns)


def test_unknown_artist_takes_the_default(spark):
    out = replay.session_replay_features(recent(spark, "12:00:00"), rates(spark, ("coldplay", 0.15)), rates(spark, ("yellow", 0.12))).first()
    assert (out["artist_smoothed_skip_rate"], out["song_smoothed_skip_rate"], out["is_cold_start_artist"]) == (0.104, 0.104, 1)


def test_progress_restart_and_idle(spark):
    t = [dt.datetime(2026, 1, 1, 12, 0, s) for s in (0, 10, 20, 30, 40)]
    polls = [
        (1, 0, t[0], "x", 5.0, 200.0, "ACTIVE"), (1, 1, t[1], "x", 100.0, 200.0, "ACTIVE"), (1, 2, t[2], "", 0.0, 0.0, "IDLE"),
        (1, 3, t[3], "x", 20.0, 200.0, "ACTIVE"), (1, 4, t[4], "y", 1.0, 200.0, "ACTIVE"),
    ]
    df = spark.createDataFrame(polls, "user_id bigint, event_id bigint, poll_ts timestamp, track_id string, progress_sec double, duration_sec double, status string")
    closed = [(r["event_id"], r["track_id"], r["listen_sec"], r["was_skipped"]) for r in replay.closed_plays(df).orderBy("event_id").collect()]
    assert closed == [(3, "x", 100.0, 1), (4, "x", 20.0, 1)]
    mood = {r["event_id"]: r["mood"] for r in replay.session_mood(df).collect()}
    assert mood == {0: "CALM_FLOW", 1: "CALM_FLOW", 3: "RESTLESS", 4: "SKIP_SPREE"}


SCORED = "model string, label int, score double"


def test_policy_numbers(spark):
    scored = spark.createDataFrame([("m", y, s) for y, s in zip([1, 1, 0, 0, 1], [0.9, 0.8, 0.7, 0.2, 0.1])], SCORED)
    r = policy.policy_utility(scored, 0.5).first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (2, 1, 1, 1)
    assert r["mb_saved"] == 2.0
    assert r["cdn_savings_usd"] == pytest.approx(2 / 1024 * 0.08, abs=1e-12)
    assert r["ux_penalty_usd"] == pytest.approx(0.05)
    assert r["net_utility_usd"] == pytest.approx(2 / 1024 * 0.08 - 0.05, abs=1e-9)


def test_champion_beats_high_recall(spark):
    champion = [(1, 0.9)] * 50 + [(1, 0.1)] * 50 + [(0, 0.8)] * 10 + [(0, 0.1)] * 990
    eager = [(1, 0.9)] * 90 + [(1, 0.1)] * 10 + [(0, 0.8)] * 300 + [(0, 0.1)] * 700
    scored = spark.createDataFrame([("champion", *x) for x in champion] + [("high_recall", *x) for x in eager], SCORED)
    net = {r["model"]: r["net_utility_usd"] for r in policy.policy_utility(scored, 0.5).collect()}
    assert net["champion"] > net["high_recall"]


def test_precision_floor_falls_back_to_f1(spark):
    scored = spark.createDataFrame([("m", 0, 0.9), ("m", 1, 0.8), ("m", 0, 0.7), ("m", 1, 0.6)], SCORED)
    r = evaluate.threshold_precision_floor(scored, 0.8).first()
    assert (r["threshold"], r["meets_floor"]) == (0.6, 0)


def test_auc_counts_ties_as_half(spark):
    scored = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.5), ("m", 1, 0.9), ("m", 0, 0.1)], SCORED)
    assert evaluate.roc_auc(scored).first()["roc_auc"] == 0.875


def audit_rows(spark, n):
    return spark.range(n).selectExpr("'RESOLVED' AS status", "1 AS actual_skipped")


def test_retrain_gate(spark):
    runs = spark.createDataFrame([(dt.datetime(2026, 1, 1, 5), "SUCCESS")], "finished_at timestamp, status string")

    def gate(n, day="2026-01-02", **more):
        return evaluate.retrain_gate(audit_rows(spark, n), runs, day, **more).first()

    assert gate(45)["triggered"] == 0 and gate(45)["should_retrain"] == 0
    assert gate(105)["should_retrain"] == 1
    assert gate(105, "2026-01-01")["should_retrain"] == 0
    assert gate(60, force=True)["should_retrain"] == 1 and gate(45, force=True)["should_retrain"] == 0


def test_gate_rejects_auc_drop(spark):
    metrics = spark.createDataFrame([("new", 0.80, 0.9)], "model string, roc_auc double, precision double")
    row = evaluate.challenger_gate(metrics, "new", "old").first()
    assert (row["champion_auc"], row["promoted"]) == (0.858, 0)
    better = spark.createDataFrame([("new", 0.861, 0.76), ("old", 0.858, 0.8)], "model string, roc_auc double, precision double")
    assert evaluate.challenger_gate(better, "new", "old").first()["promoted"] == 1


def test_append_is_idempotent(spark, tmp_path):
    schema = "played_at string, song_name string"
    record = spark.createDataFrame([("2026-01-01T00:00:00Z", "x")], schema)
    path = str(tmp_path / "log")
    assert sinks.append_new(record, path, ["played_at"], schema) == (1, 0)
    assert sinks.append_new(record, path, ["played_at"], schema) == (0, 1)


def test_newer_prediction_replaces_and_outcome_resolves(spark):
    at = [dt.datetime(2026, 1, 1, 12, m) for m in range(6)]
    p = spark.createDataFrame(
        [(1, 0, at[0], "s", "a", 0.2, 0), (1, 1, at[1], "s", "a", 0.9, 0), (1, 4, at[4], "s", "a", 0.1, 1)],
        "user_id bigint, event_id bigint, made_at timestamp, song_name string, artist_name string, prob double, flagged int",
    )
    o = spark.createDataFrame(
        [(1, 2, at[2], "s", "a", 20.0, 200.0, 1), (1, 3, at[3], "s", "a", 200.0, 200.0, 0)],
        "user_id bigint, event_id bigint, made_at timestamp, song_name string, artist_name string, listen_sec double, total_sec double, was_skipped int",
    )
    got = {r["outcome_id"]: (r["predicted_prob"], r["evaluation_result"], r["cdn_mb_saved"], r["risk_tier"]) for r in audit.resolve_outcomes(p, o).collect()}
    assert got == {2: (0.9, "TRUE_POSITIVE", 1.0, "CRITICAL"), 3: (0.35, "TRUE_NEGATIVE", 0.0, "UNKNOWN")}
    pending = audit.pending_predictions(p, o).collect()
    assert [(r["prediction_id"], r["predicted_skip"]) for r in pending] == [(4, 1)]
