"""Batches through the feature store equal one feature matrix over the whole history."""

import pytest
from pyspark.sql import functions as F

from playlens.operators import features
from playlens.operators.feature_store import FeatureStore
from playlens.session import scratch_path
from tests.test_features import tie_heavy

WINDOWS = {"skips_last_24h": 86400}


def rows(df):
    return sorted(map(str, df.collect()))


def cut(plays, parts):
    """Batches that part even plays of one time: by rank of (time, id) in all."""
    order = F.struct("time_stamp", "event_id")
    edges = [r[0] for r in plays.select(order.alias("o")).orderBy("o").collect()]
    bounds = [edges[len(edges) * i // parts] for i in range(1, parts)]
    at = sum((F.when(order >= F.struct(F.lit(b[0]), F.lit(b[1]).cast("long")), 1).otherwise(0) for b in bounds), F.lit(0))
    return [plays.where(at == i) for i in range(parts)]


def through(spark, plays, parts):
    store = FeatureStore(spark, scratch_path(spark, "store"), WINDOWS)
    for i, part in enumerate(cut(plays, parts)):
        store.append(part, i)
    return store


@pytest.mark.parametrize("parts", [1, 3])
def test_batches_equal_the_matrix(spark, tables, parts):
    plays = tables.plays.withColumn("user_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id") % 6))
    want = features.feature_matrix(plays, WINDOWS)
    got = through(spark, plays, parts).features()
    assert rows(got.select(*want.columns)) == rows(want)


def test_ties_across_the_border_of_batches(spark):
    plays = tie_heavy(spark)[1]
    want = features.feature_matrix(plays, WINDOWS)
    assert rows(through(spark, plays, 5).features().select(*want.columns)) == rows(want)


def test_hot_users(spark, tables, hot):
    plays = tables.plays.withColumn("user_id", F.when(F.col("user_id") % 3 != 0, F.lit(1)).otherwise(F.col("user_id")))
    want = rows(features.feature_matrix(plays, WINDOWS))
    hot(75)
    assert rows(through(spark, plays, 2).features().select(*features.matrix_names([*features.MATRIX_WINDOWS, *WINDOWS]))) == want


def test_a_batch_again_and_a_late_batch(spark, tables):
    plays = tables.plays
    first, second, third = cut(plays, 3)
    store = FeatureStore(spark, scratch_path(spark, "store"), WINDOWS)
    store.append(first, 0)
    store.append(second, 1)
    store.append(second, 1)
    assert store.features().count() == first.count() + second.count()
    with pytest.raises(ValueError, match="batch 2"):
        store.append(first, 2)
    store.append(third, 2)
    want = features.feature_matrix(plays, WINDOWS)
    assert rows(store.features().select(*want.columns)) == rows(want)


def test_what_a_batch_reads_does_not_grow(spark, tables):
    """The same listeners play the same songs every day: the carry stays as it is."""
    day = tables.plays.where("user_id < 20").withColumn("time_stamp", F.col("time_stamp").cast("date").cast("timestamp"))
    day = day.withColumn("time_stamp", F.lit("2024-01-01").cast("timestamp"))
    store = FeatureStore(spark, scratch_path(spark, "store"), {})
    sizes = []
    for i in range(4):
        store.append(day.withColumns({"time_stamp": F.date_add("time_stamp", i).cast("timestamp"), "event_id": F.col("event_id") + i * 10_000_000}), i)
        sizes.append(store.carry(i).count())
    assert sizes[1] == sizes[3]  # the first leaves no earlier skips behind
    inputs = store._told(features.labelled(day).withColumn("t_us", F.lit(1).cast("long")), store.carry(3), day).inputFiles()
    assert not any("/features/" in f or "/carry/0" in f or "/carry/1" in f or "/carry/2" in f for f in inputs)
