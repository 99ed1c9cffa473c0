"""Shape of the physical plans."""

import re

import pytest

from playlens.operators import features, rank
from playlens.plans import registry
from tests.conftest import SMALL

registry.load()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_matrix_shuffles_plays_once(tables):
    text = plan(features.feature_matrix(tables.plays_long))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "SinglePartition" not in text


# one key on purpose: plain only while its measured rows stay under the hot limit
MEASURED = {"global_prior_all_users", "order_positions"}
SINGLE = re.compile(r"Window [^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition")
# one of each kind; tables of calendar rows (days, months, hour blocks) may use a single partition
KINDS = """
rank_artist_alltime_plays rank_song_day genre_listened_month genre_explored_year volume_hour skip_heatmap reason_start_share
lifecycle_flows platform_outcome_ratio quickest_skipped_artists attention_shift_artist one_hit_wonders sessionize binge_histogram
session_quantiles silent_gap_distribution artist_month_streaks silent_breaks date_difference genre_cascade artist_top3_imputation
latest_rate_lookup lookup_with_fallback target_encode_multitag rolling_skips asof_last_skip listen_streak feature_matrix
session_replay_features session_mood pending_upsert resolve_outcomes audit_metrics pr_curve roc_auc threshold_sweep
strategy_compare challenger_gate class_weight
""".split()


@pytest.mark.parametrize("name", KINDS)
def test_no_window_over_a_single_partition(spark, name):
    text = plan(registry.QUERIES[name](spark, SMALL))
    assert not SINGLE.search(text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "PythonUDF" not in text


@pytest.mark.parametrize("name", sorted(MEASURED))
def test_one_large_key_is_split(spark, hot, name):
    hot(100)
    text = plan(registry.QUERIES[name](spark, SMALL))
    assert re.search(r"Window [^\n]*_chunk", text)


SHARES = "reason_start_share lifecycle_flows platform_share offline_share country_share skip_cdf genre_coverage rare_value_lumping".split()


@pytest.mark.parametrize("name", [n for n in SHARES if n in registry.QUERIES])
def test_totals_reuse_the_shuffle_of_the_counts(spark, name):
    df = registry.QUERIES[name](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_calendar_and_append_counts_read_once(spark):
    for name, scans in (("date_spine_left_join", 1), ("daily_usage_trend", 1)):
        assert plan(registry.QUERIES[name](spark, SMALL)).count("FileScan parquet [o_") == scans


def test_per_period_cut_limits_before_the_shuffle(tables):
    text = plan(rank.top_per_period(tables.plays_long, ["artist_name"], "year", n=3))
    assert "WindowGroupLimit" in text and text.rindex("Partial") > text.index("Exchange")


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(registry.QUERIES["scan_filtered_history"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_unused_dimension_is_dropped(tables):
    assert "nation" not in plan(rank.top_entities(tables.plays, ["artist_name"]))
