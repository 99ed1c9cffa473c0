"""What a task of the ordered engine gets stays bounded, in columns and in rows."""

import pytest

from playlens.operators import feature_store, features, ordered
from playlens.plans import registry
from playlens.session import scratch_path
from tests.conftest import SMALL

registry.load()


@pytest.fixture
def stored(monkeypatch):
    """The columns of what is written as chunks."""
    seen, real = [], ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label: seen.append(set(df.columns)) or real(df, label))
    return seen


@pytest.mark.parametrize("name, columns", [("order_positions", {"event_id", "time_stamp", "t_us", "_all"}), ("global_prior_all_users", {"user_id", "event_id", "time_stamp", "t_us", "is_skip"})])
def test_a_global_order_moves_only_what_it_needs(spark, hot, stored, name, columns):
    hot(300)
    assert registry.QUERIES[name](spark, SMALL).count() > 700
    assert stored and all(c <= columns | {ordered.CHUNK} for c in stored)


def test_tasks_follow_the_rows(spark, tables, monkeypatch):
    plays = tables.plays
    plain = ordered.OrderedRows.by(plays, ["user_id"], ["time_stamp", "event_id"]).cold
    monkeypatch.setattr(ordered, "TASK_ROWS", 50)
    many = ordered.OrderedRows.by(plays, ["user_id"], ["time_stamp", "event_id"]).cold
    n = plays.count()
    assert many.rdd.getNumPartitions() == -(-n // 50) > plain.rdd.getNumPartitions()
    assert many.count() == n


def test_the_feature_store_cuts_long_histories(spark, tables, monkeypatch, stored):
    monkeypatch.setattr(feature_store, "TASK_ROWS", 75)
    store = feature_store.FeatureStore(spark, scratch_path(spark, "sizes"))
    plays = tables.plays
    store.append(plays, 0)
    assert stored  # chunks, although no user has as many rows as the session's limit
    want = features.feature_matrix(plays)
    assert sorted(map(str, store.features().select(*want.columns).collect())) == sorted(map(str, want.collect()))
