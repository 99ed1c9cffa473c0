"""Prediction audit: pending predictions, resolution by outcomes, confusion metrics.

Nothing is updated in place. Predictions and outcomes are append-only tables and the state of a track
follows from their order: a newer prediction replaces the pending one, an outcome resolves it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.ordered import OrderedRows, r_last, r_sum

KEY = ["user_id", "song_name", "artist_name"]


def log_predictions(predictions: DataFrame, threshold: float = 0.45) -> DataFrame:
    """Predicted skip: the caller's flag or a probability from the threshold on."""
    return predictions.withColumns(
        {
            "predicted_skip": ((F.col("flagged") == 1) | (F.col("prob") >= threshold)).cast("int"),
            "risk_tier": X.risk_tier_3("prob", threshold),
        }
    )


def pending_predictions(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The one open prediction per track: the last one after the track's last outcome. Plain maxima, so
    a track with many predictions still combines map-side."""
    p = log_predictions(predictions).select(
        *KEY, F.struct("made_at", "event_id").alias("o"), F.struct("made_at", "event_id", "prob", "predicted_skip", "risk_tier").alias("p")
    )
    r = outcomes.select(*KEY, F.struct("made_at", "event_id").alias("o"))
    both = p.unionByName(r, allowMissingColumns=True)
    last = both.groupBy(*KEY).agg(
        F.max(F.when(F.col("p").isNull(), F.col("o"))).alias("resolved"), F.max("p").alias("p")
    )
    open_ = F.col("p").isNotNull() & (F.col("resolved").isNull() | (F.struct("p.made_at", "p.event_id") > F.col("resolved")))
    return last.where(open_).select(
        *KEY,
        F.col("p.event_id").alias("prediction_id"),
        F.col("p.made_at").alias("predicted_at"),
        F.col("p.prob").alias("predicted_prob"),
        "p.predicted_skip",
        "p.risk_tier",
        F.lit("PENDING").alias("status"),
    )


def resolve_outcomes(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every outcome with the prediction it resolves: the last one since the track's previous outcome, or
    the cold-start default when there is none."""
    p = log_predictions(predictions).select(
        *KEY, "made_at", "event_id", F.lit(0).alias("is_outcome"), F.struct("prob", "predicted_skip", "risk_tier").alias("p")
    )
    o = outcomes.select(
        *KEY, "made_at", "event_id", F.lit(1).alias("is_outcome"), F.struct("listen_sec", "total_sec", "was_skipped").alias("r")
    )
    both = p.unionByName(o, allowMissingColumns=True).withColumn("t_us", X.micros("made_at"))
    rows = OrderedRows.by(both, KEY, ["t_us", "event_id"])
    rows = rows.running({"epoch": r_sum(F.col("is_outcome"))}).running({"open": r_last(F.col("p"))}, ["epoch"])
    return graded(rows.rows().where(F.col("is_outcome") == 1))


def graded(done: DataFrame) -> DataFrame:
    """Resolved and graded outcomes from ``event_id``, ``made_at``, the outcome ``r`` and the ``open`` prediction or null."""
    resolved = done.select(
        *KEY,
        F.col("event_id").alias("outcome_id"),
        F.col("made_at").alias("resolved_at"),
        F.coalesce("open.prob", F.lit(X.COLD_START_PROB)).alias("predicted_prob"),
        F.coalesce("open.predicted_skip", F.lit(0)).alias("predicted_skip"),
        F.coalesce("open.risk_tier", F.lit("UNKNOWN")).alias("risk_tier"),
        X.round_even("r.listen_sec", 1).alias("actual_played_sec"),
        X.round_even("r.total_sec", 1).alias("total_duration_sec"),
        F.col("r.was_skipped").alias("actual_skipped"),
    )
    return resolved.withColumns(
        {
            "evaluation_result": X.grade("predicted_skip", "actual_skipped"),
            "cdn_mb_saved": X.mb_saved("predicted_skip", "actual_skipped", "actual_played_sec"),
            "status": F.lit("RESOLVED"),
        }
    )


def confusion_counts():
    names = {"tp": "TRUE_POSITIVE", "tn": "TRUE_NEGATIVE", "fp": "FALSE_POSITIVE", "fn": "FALSE_NEGATIVE"}
    return [F.count_if(F.col("evaluation_result") == v).alias(k) for k, v in names.items()]


def metric_columns() -> dict:
    tp, tn, fp, fn, n = (F.col(c) for c in ("tp", "tn", "fp", "fn", "total_evaluated"))
    return {
        "precision": X.percent(tp, tp + fp, 1),
        "recall": X.percent(tp, tp + fn, 1),
        "accuracy": X.percent(tp + tn, n, 1),
    }


def audit_metrics(audit: DataFrame) -> DataFrame:
    resolved = audit.where(F.col("status") == "RESOLVED")
    out = resolved.agg(
        F.count(F.lit(1)).alias("total_evaluated"),
        *confusion_counts(),
        X.round_even(F.coalesce(F.sum("cdn_mb_saved"), F.lit(0.0)), 2).alias("mb_saved"),
    )
    return out.withColumns(metric_columns())


def recent_resolved(audit: DataFrame, n: int = 10) -> DataFrame:
    resolved = audit.where(F.col("status") == "RESOLVED")
    return resolved.orderBy(F.col("played_at").desc(), F.col("event_id").desc()).limit(n)


def resolved_count(audit: DataFrame) -> DataFrame:
    done = (F.col("status") == "RESOLVED") | F.col("actual_skipped").isNotNull()
    return audit.agg(F.count_if(done).alias("resolved"))


def append_counts(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """(inserted, duplicates) of an idempotent append."""
    per_key = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = stored.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)]).distinct().withColumn("_stored", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)])
    marked = per_key.join(known, same, "left")
    inserted = F.count_if(F.col("_stored").isNull())
    return marked.agg(inserted.alias("inserted"), (F.coalesce(F.sum("n"), F.lit(0)) - inserted).alias("duplicates"))


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Older audit rows gain the newer columns as nulls."""
    return old.unionByName(new, allowMissingColumns=True)
