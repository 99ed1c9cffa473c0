"""Streams cut into several deliveries equal the batch operators."""

import datetime as dt

from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import audit, replay
from playlens.session import scratch_path
from playlens.streaming import ingest, run, stateful, windows



def deliver(spark, frames, time, job, parts=2, beat_days=40):
    """In several deliveries by time, each a query of its own that goes on from the checkpoint; rows lie in no order. Then a heartbeat.
    Returns the rows and the state's size after each delivery."""
    sources = [scratch_path(spark, "src") for _ in frames]
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "chk")
    t = F.unix_micros(time)
    ends = [f.agg(F.min(t), F.max(t)).first() for f in frames]
    lo, hi = min(e[0] for e in ends), max(e[1] for e in ends)
    step, sizes = (hi - lo) // parts + 1, []
    for i in range(parts + 1):
        for frame, source in zip(frames, sources):
            beat = [F.timestamp_micros(F.lit(hi + beat_days * 86400 * 1000000)).alias(c) if c == time else F.lit(None).cast(frame.schema[c].dataType).alias(c) for c in frame.columns]
            some = frame.where((t >= lo + i * step) & (t < lo + (i + 1) * step)).orderBy(F.rand(i)) if i < parts else spark.range(1).select(*beat)
            some.coalesce(1).write.mode("append").parquet(source)
        query = run.drain(job(*[run.read_stream(spark, s, f.schema) for f, s in zip(frames, sources)]), out, checkpoint)
        sizes.append([o["numRowsTotal"] for o in query.lastProgress["stateOperators"]] if query.lastProgress else None)
    return spark.read.parquet(out).drop(run.BATCH), sizes


def same(a, b):
    columns = a.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*columns).collect()))
    assert a.count() > 700


def nulled(df):
    return df.withColumn("user_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id")))


def replay_input(tables):
    return nulled(tables.recent_plays.select("user_id", "event_id", "played_at", "duration_sec", "song_name", "artist_name"))


def test_session_replay_over_several_deliveries(spark, tables):
    recent = replay_input(tables).withColumn("duration_sec", F.when(F.col("event_id") % 9 != 0, F.col("duration_sec")))
    empty = spark.createDataFrame([], "lookup_key string, rate double")
    got, sizes = deliver(spark, [recent], "played_at", lambda s: stateful.session_replay(s, empty, empty, 60))
    same(got, replay.session_replay_features(recent, empty, empty))
    assert sizes[-1][0] <= 6  # all listeners are idle by then and forgotten; only the heartbeat's is left, if at all


def test_mood_over_several_deliveries(spark, tables):
    progress = nulled(tables.progress).withColumns(
        {c: F.when(F.col("event_id") % k != 0, F.col(c)) for c, k in (("track_id", 11), ("progress_sec", 13), ("duration_sec", 17))}
    )
    got, _ = deliver(spark, [progress], "poll_ts", lambda s: stateful.mood(s, 60))
    same(got, replay.session_mood(progress))


def test_who_is_away_too_long_begins_anew(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(1, 1, at(0), "a", 5.0, 200.0, "ACTIVE"), (1, 2, at(10), "b", 1.0, 200.0, "ACTIVE"), (2, 3, at(90_000), "z", 1.0, 9.0, "ACTIVE"), (1, 4, at(200_000), "b", 2.0, 200.0, "ACTIVE")]
    polls_ = spark.createDataFrame(rows, "user_id long, event_id long, poll_ts timestamp, track_id string, progress_sec double, duration_sec double, status string")
    flags = {}
    for expire in (None, 3600):
        got, _ = deliver(spark, [polls_], "poll_ts", lambda s, e=expire: stateful.mood(s, 60, e))
        flags[expire] = {r.event_id: r.previous_song_skipped for r in got.collect()}
    assert flags == {None: {1: 0, 2: 1, 3: 0, 4: 1}, 3600: {1: 0, 2: 1, 3: 0, 4: 0}}


def test_idle_listeners_cost_nothing(spark, tables):
    """State rows that a batch writes follow its own rows, not the listeners there are."""
    recent = replay_input(tables).where("user_id IS NOT NULL").withColumn("played_at", F.date_trunc("hour", "played_at") + F.make_dt_interval(secs=F.col("event_id") % 60))
    newest = recent.agg(F.max("played_at")).first()[0]
    empty = spark.createDataFrame([], "lookup_key string, rate double")
    crowd = spark.range(3000).select((F.col("id") + 10_000).alias("user_id"), (F.col("id") + 1_000_000).alias("event_id"), F.lit(newest).alias("played_at"), F.lit(100.0).alias("duration_sec"), F.lit("s").alias("song_name"), F.lit("a").alias("artist_name"))
    source, out, checkpoint = (scratch_path(spark, n) for n in ("idle", "idle-out", "idle-chk"))
    stream = lambda: stateful.session_replay(run.read_stream(spark, source, recent.schema), empty, empty, 0, 86400)
    crowd.coalesce(1).write.mode("append").parquet(source)
    run.drain(stream(), out, checkpoint)
    later = crowd.limit(5).withColumns({"played_at": F.lit(newest + dt.timedelta(seconds=60)), "event_id": F.col("event_id") + 5_000_000})
    later.coalesce(1).write.mode("append").parquet(source)
    query = run.drain(stream(), out, checkpoint)
    touched = [sum(o["numRowsUpdated"] + o["numRowsRemoved"] for o in p["stateOperators"]) for p in query.recentProgress]
    total = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert total >= 3000 and 0 < sum(touched) < 100


def test_outcomes_meet_predictions_of_another_stream(spark, tables):
    p, o = nulled(tables.predictions), nulled(tables.outcomes)
    got, _ = deliver(spark, [p, o], "made_at", lambda a, b: stateful.resolve(a, b, 0, None))
    want = audit.resolve_outcomes(p, o)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_old_predictions_leave_the_state(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    p = spark.createDataFrame([(1, "s", "a", at(0), 1, 0.9, 0), (1, "s", "a", at(30), 2, 0.8, 0), (1, "x", "a", at(1), 3, 0.7, 0)], "user_id long, song_name string, artist_name string, made_at timestamp, event_id long, prob double, flagged int")
    o = spark.createDataFrame([(1, "s", "a", at(26), 10, 5.0, 60.0, 1), (1, "s", "a", at(31), 11, 5.0, 60.0, 0), (1, "s", "a", at(32), 12, 5.0, 60.0, 0)], "user_id long, song_name string, artist_name string, made_at timestamp, event_id long, listen_sec double, total_sec double, was_skipped int")
    got, sizes = deliver(spark, [p, o], "made_at", lambda a, b: stateful.resolve(a, b, 0, 86400))
    rows = {r.outcome_id: (r.predicted_prob, r.risk_tier) for r in got.collect()}
    # the first is 26 hours behind its prediction, the second took the newer one, the third finds none left
    assert {k: v[0] for k, v in rows.items()} == {10: X.COLD_START_PROB, 11: 0.8, 12: X.COLD_START_PROB} and rows[10][1] == "UNKNOWN"
    assert sum(sizes[-1]) <= 4  # the heartbeats'


def polls(spark, *plays):
    rows = [(u, [((at,) + ((f"t{at}", "song", 200000, [("first",), ("second",)], ("alb",)),)) for at in times]) for u, times in plays]
    from playlens.sources import schemas

    return spark.createDataFrame(rows, schemas.RECENT_POLL)


def test_poll_defaults_and_bad_time(spark):
    from playlens.sources import schemas

    rows = [(1, [("2026-09-24T15:30:00.000Z", (None, None, None, [], (None,))), ("not a time", ("x", "y", 1000, [("a",)], ("b",))), (None, ("x", "y", 1000, [("a",)], ("b",)))])]
    got = ingest.flatten_polls(spark.createDataFrame(rows, schemas.RECENT_POLL)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["track_id"], r["song_name"], r["artist_name"], r["album_name"], r["duration_sec"]) == (
        "Unknown Track::Unknown Artist", "Unknown Track", "Unknown Artist", "Unknown Album", 180.0)
    assert r["played_at"] == dt.datetime(2026, 9, 24, 15, 30)


def test_overlapping_polls_store_each_play_once(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("polls", "polls-out", "polls-chk"))
    first = polls(spark, (1, ["2026-01-01T10:00:00Z", "2026-01-01T10:05:00Z"]))
    second = polls(spark, (1, ["2026-01-01T10:05:00Z", "2026-01-01T10:09:00Z"]))
    for part in (first, second):
        part.write.mode("append").json(source)
        stream = run.read_stream(spark, source, part.schema, "json")
        flat = ingest.flatten_polls(stream).select("user_id", "played_at")
        run.drain(flat, out, checkpoint, sink=run.append_once(out, ["user_id", "played_at"], "played_at"))
    assert spark.read.parquet(out).count() == 3


def test_retried_batch_leaves_one_copy(spark):
    out = scratch_path(spark, "retry")
    sink = run.append_once(out, ["user_id", "played_at"], "played_at")
    batch = spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 2))], "user_id bigint, played_at timestamp")
    sink(batch, 0)
    sink(batch, 0)
    sink(batch, 1)
    assert spark.read.parquet(out).count() == 2


def test_windows_appear_once_closed(spark, tables):
    source = scratch_path(spark, "win")
    tables.plays.write.parquet(source)
    stream = run.read_stream(spark, source, tables.plays.schema)
    got = run.collect_stream(windows.tumbling_volume(stream, "1 day", "0 seconds"), "win-out")
    days = tables.plays.select(F.to_date("time_stamp")).distinct().count()
    assert got.count() == days - 1  # the last day is still open


def test_sliding_state_follows_windows_not_listeners(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(u if u % 50 else None, at(s), u % 3 - 1 if u % 3 else None) for u in range(400) for s in (u % 170, u % 170, 200 + u % 100)]
    rows += [(7, at(1500), 1), (8, at(800), 1), (9, at(3000), 1)]  # the second comes late: its first window is closed, the others are open
    plays = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "user_id long, time_stamp timestamp, skipped int, event_id long")
    source, out, checkpoint = (scratch_path(spark, n) for n in ("slide", "slide-out", "slide-chk"))
    sizes = []
    for some in ("event_id < 700", "event_id between 700 and 1200", "event_id = 1201", "event_id = 1202"):
        plays.where(some).coalesce(1).write.mode("append").parquet(source)
        query = run.drain(windows.sliding_skips(run.read_stream(spark, source, plays.schema)), out, checkpoint)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else None)
    expected = {}
    for u, t, skipped in rows:
        for k in range(5):
            start = at(int((t - at(0)).total_seconds()) // 180 * 180 - 180 * k)
            if start + dt.timedelta(minutes=15) <= at(2400) and (t, start) != (at(800), at(0)):  # the last watermark
                expected.setdefault((u, start), []).append(skipped)
    told = {(r.user_id, r.window_start): (r.plays, r.skips) for r in spark.read.parquet(out).collect()}
    known = {k: [s for s in v if s is not None] for k, v in expected.items()}
    assert told == {k: (len(v), sum(known[k]) if known[k] else None) for k, v in expected.items()} and len(told) > 1000
    assert max(s for s in sizes if s) <= 20 * windows.BUCKETS  # a row for each listener before: over 1,000
