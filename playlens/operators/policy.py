"""Prices of decision thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.evaluate import confusion, safe_ratio

# --- fixed values -------------------------------------------------------------------------------
CDN_COST_PER_GB = 0.08
UX_PENALTY_PER_FP = 0.05
SWEEP = [round(0.10 + 0.05 * i, 2) for i in range(18)]
STRATEGIES = [
    ("champion_sla", "champion", 0.749),
    ("champion_low", "champion", 0.50),
    ("high_recall", "high_recall", 0.50),
    ("high_recall_aggressive", "high_recall", 0.30),
]


def utility_columns() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    mb = tp * X.MB_PER_PREFETCH
    saved = mb / 1024.0 * CDN_COST_PER_GB
    penalty = fp * UX_PENALTY_PER_FP
    return {
        "precision": precision,
        "recall": recall,
        "f1": safe_ratio(2 * precision * recall, precision + recall),
        "mb_saved": mb,
        "gb_saved": mb / 1024.0,
        "cdn_savings_usd": saved,
        "ux_penalty_usd": penalty,
        "net_utility_usd": saved - penalty,
    }


def policy_utility(scored: DataFrame, threshold: float) -> DataFrame:
    return confusion(scored, threshold).withColumns({"threshold": F.lit(threshold), **utility_columns()})


def threshold_sweep(scored: DataFrame, thresholds=tuple(SWEEP)) -> DataFrame:
    """One pass over the scores: each row is reduced to how many thresholds it reaches, and only those
    few counted levels meet the thresholds."""
    level = sum(((F.col("score") >= t).cast("int") for t in thresholds[1:]), (F.col("score") >= thresholds[0]).cast("int"))
    counts = scored.groupBy("model", level.alias("level")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    grid = F.posexplode(F.array(*[F.lit(t) for t in thresholds])).alias("step", "threshold")
    called = F.col("level") > F.col("step")
    out = counts.select("*", grid).groupBy("model", "threshold").agg(
        F.sum(F.when(called, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(~called, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(called, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~called, F.col("pos")).otherwise(0)).alias("fn"),
    )
    return out.withColumns(utility_columns())


def strategy_compare(scored: DataFrame, strategies=tuple(STRATEGIES)) -> DataFrame:
    """Named (model, threshold) strategies side by side, and a baseline that does nothing. All strategies
    are counted in one aggregate."""

    def entry(name: str, model: str, threshold: float) -> Column:
        mine = F.col("model") == model
        called, positive = F.col("score") >= threshold, F.col("label") == 1
        return F.struct(
            F.lit(name).alias("strategy"),
            F.lit(threshold).alias("threshold"),
            F.count_if(mine & called & positive).alias("tp"),
            F.count_if(mine & ~called & ~positive).alias("tn"),
            F.count_if(mine & called & ~positive).alias("fp"),
            F.count_if(mine & ~called & positive).alias("fn"),
        )

    zero = F.lit(0).cast("bigint")
    baseline = F.struct(
        F.lit("baseline").alias("strategy"), F.lit(0.0).alias("threshold"),
        zero.alias("tp"), zero.alias("tn"), zero.alias("fp"), zero.alias("fn"),
    )
    counted = scored.agg(F.array(*[entry(*s) for s in strategies], baseline).alias("s"))
    return counted.select(F.inline("s")).withColumns(utility_columns())


def best_threshold(sweep: DataFrame, metric: str = "mb_saved") -> DataFrame:
    """The sweep row with the largest metric per model; among equals the lowest threshold."""
    row = F.struct(*[c for c in sweep.columns if c != "model"])
    best = sweep.groupBy("model").agg(F.max_by(row, F.struct(F.col(metric), -F.col("threshold"))).alias("b"))
    return best.select("model", "b.*")
