"""One rule for null keys: a null equals a null, in anti-joins and spines; null measures don't count."""

import datetime as dt

from playlens.operators import engagement, enrich, islands
from playlens.streaming import run


def test_known_records_with_null_keys_are_not_new(spark):
    a = spark.createDataFrame([(1, "x"), (None, "x"), (2, None), (None, None), (None, None)], "k int, s string")
    assert enrich.new_events(a, a, ["k", "s"]).count() == 0
    assert enrich.new_events(a, a.where("k = 1"), ["k", "s"]).count() == 3


def test_append_once_with_null_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    sink = run.append_once(path, ["user_id", "played_at"], "played_at")
    batch = spark.createDataFrame([(None, dt.datetime(2026, 1, 1)), (1, None), (1, dt.datetime(2026, 1, 2))], "user_id long, played_at timestamp")
    sink(batch, 0)
    sink(batch, 1)
    assert spark.read.parquet(path).count() == 3


def test_silent_dates_of_a_null_user(make_plays):
    plays = make_plays([(None, 1, "2026-01-01 10:00:00", 0), (None, 2, "2026-01-03 10:00:00", 0), (7, 3, "2026-01-01 10:00:00", 0), (7, 4, "2026-01-02 10:00:00", 0)])
    assert [tuple(r) for r in islands.silent_dates(plays).collect()] == [(None, dt.date(2026, 1, 2))]


def test_skip_cdf_leaves_null_seconds_out(make_plays):
    plays = make_plays([(1, i, "2026-01-01 10:00:00", 1, {"sec_played": s}) for i, s in enumerate([5, 5, 7, None])])
    got = {r["sec_played"]: (r["skips"], r["at_most"], r["cdf"]) for r in engagement.skip_cdf(plays).collect()}
    assert got == {5: (2, 2, 0.666667), 7: (1, 3, 1.0)}


def test_compaction_of_the_ends_of_bigint(spark):
    from playlens.operators import quality

    ends = spark.createDataFrame([(2**63 - 1, -129, 1.5, 2.0**63, None), (-(2**63), 127, None, 1.0, None)], "a bigint, b int, c double, d double, e int")
    plan = {r["column_name"]: r["target_type"] for r in quality.compaction_plan(ends).collect()}
    assert plan == {"a": "bigint", "b": "smallint", "c": "double", "d": "double", "e": "double"}
    assert sorted(r["a"] for r in quality.compact(ends).collect()) == [-(2**63), 2**63 - 1]


def test_report_is_whole_unless_cut_and_matches_its_files(spark, tmp_path):
    from playlens.sources import sinks

    frame = spark.range(25).selectExpr("id AS n", "id * 2 AS twice").orderBy("n")
    text = sinks.report_sections({"one": {"all rows": frame}}, str(tmp_path / "a"))
    assert text.count("\n| ") == 27 and spark.read.json(str(tmp_path / "a/one/all_rows")).count() == 25
    text = sinks.report_sections({"one": {"all rows": frame}}, str(tmp_path / "b"), 3)
    assert sorted(r["n"] for r in spark.read.json(str(tmp_path / "b/one/all_rows")).collect()) == [0, 1, 2] and text.count("\n| ") == 5
