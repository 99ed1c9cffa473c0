"""The chunked path gives exactly the rows of the plain one."""

import pytest
from pyspark.sql import functions as F

from playlens.operators import audit, evaluate, features, replay, sessions, splits
from playlens.operators.ordered import CHUNK, OrderedRows, lag_struct, r_count, r_last, r_max, r_sum
from tests.test_features import tie_heavy

JOBS = {
    "feature_matrix": lambda t: features.feature_matrix(t.plays),
    "multitag": lambda t: features.target_encode_multitag(t.plays),
    "sessionize": lambda t: sessions.sessionize(t.plays, 43200),
    "silent_gaps": lambda t: sessions.silent_gaps(t.plays),
    "replay": lambda t: replay.infer_outcome(t.recent_plays),
    "mood": lambda t: replay.session_mood(t.progress),
    "resolve": lambda t: audit.resolve_outcomes(t.predictions, t.outcomes),
    "pr_curve": lambda t: evaluate.pr_curve(t.scored_long()),
    "order": lambda t: splits.order_positions(t.plays).select("event_id", "position"),
}


def rows(df):
    columns = [c for c in df.columns if c not in ("tags", "time_stamp")]
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("job", sorted(JOBS))
def test_hot_equals_cold(tables, hot, job):
    hot(10_000_000)
    plain = rows(JOBS[job](tables))
    hot({"pr_curve": 400, "order": 300, "resolve": 3}.get(job, 75))
    assert rows(JOBS[job](tables)) == plain


class Nulled:
    """The canonical tables with half of the users null: the largest key of all."""

    def __init__(self, tables):
        self.tables = tables

    def __getattr__(self, name):
        frame = getattr(self.tables, name)
        return frame.withColumn("user_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id")))


@pytest.mark.parametrize("job", ["feature_matrix", "sessionize", "silent_gaps", "replay", "mood", "resolve"])
def test_hot_null_key_loses_no_row(tables, hot, job):
    some = Nulled(tables)
    hot(10_000_000)
    plain = rows(JOBS[job](some))
    hot(3 if job == "resolve" else 75)
    assert rows(JOBS[job](some)) == plain


def test_appended_rows_make_a_key_hot(spark, tmp_path):
    from playlens.operators.ordered import hot_keys

    path = str(tmp_path / "grown")
    spark.range(50).selectExpr("1L AS user_id", "id").write.parquet(path)
    assert hot_keys(spark.read.parquet(path), ["user_id"], 75) == []
    spark.range(1000).selectExpr("1L AS user_id", "id").write.mode("append").parquet(path)
    assert hot_keys(spark.read.parquet(path), ["user_id"], 75) == [(1, 1050)]


def test_split_is_used_and_balanced(spark, hot):
    _, plays = tie_heavy(spark)
    ordered = OrderedRows.by(plays.withColumn("t_us", F.unix_micros("time_stamp")), ["user_id"], ["t_us", "event_id"], 100)
    sizes = [r["count"] for r in ordered.hot.groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 150
    assert ordered.cold.select("user_id").distinct().count() == 3
    assert ordered.rows().count() == 600


def test_every_kind_in_both_directions(spark):
    df = spark.range(40).select(
        F.lit(1).alias("k"), (F.col("id") * 7 % 40).alias("o"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"), (F.col("id") % 2).alias("s")
    )
    specs = {
        "n": r_count(), "total": r_sum(F.col("v")), "top": r_max(F.col("v"), inclusive=True), "seen": r_last(F.col("v")), "before": lag_struct("o", "v"),
    }
    for order in (["o"], ["-o"]):
        plain, chunked = (
            OrderedRows.by(df, ["k"], order, limit).running(specs).running({"per": r_count(inclusive=True)}, ["s"]).rows() for limit in (1000, 8)
        )
        assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.collect()))


def test_scratch_follows_the_session_setting(spark, tmp_path):
    from playlens.session import scratch_dir

    old = spark.conf.get("spark.checkpoint.dir", None)
    expected = old or spark.conf.get("playlens.local.scratch", None) or scratch_dir(spark)
    assert scratch_dir(spark) == expected
