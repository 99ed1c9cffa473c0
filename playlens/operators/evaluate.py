"""Curves, thresholds and reports over a scored table (model, score, label)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.ordered import OrderedRows, r_sum
from playlens.session import materialize

EPSILON = 1e-9


def score_counts(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score: all later steps work on this table."""
    return scored.groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def cumulative(scored: DataFrame) -> DataFrame:
    """tp / fp when every score >= this one is called positive, plus the model's totals p and n.
    The counts are read three times from here on, so they are stored: the scored rows are read once."""
    counts = materialize(score_counts(scored), "scores")
    totals = counts.groupBy("model").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    rows = OrderedRows.by(counts, ["model"], ["-score"])
    running = rows.running({"tp": r_sum(F.col("pos"), inclusive=True), "fp": r_sum(F.col("neg"), inclusive=True)}).rows()
    return running.join(F.broadcast(totals), "model")  # one row per model


def pr_curve(scored: DataFrame) -> DataFrame:
    c = cumulative(scored)
    return c.select(
        "model",
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(1.0).alias("recall"),
    )


def f1_of(precision: Column, recall: Column, floor: bool = False) -> Column:
    total = precision + recall
    return 2 * precision * recall / (F.greatest(total, F.lit(EPSILON)) if floor else total + EPSILON)


def _best(curve: DataFrame, metric: Column) -> DataFrame:
    """The curve row of the largest metric per model; among equals the lowest threshold."""
    row = F.struct("threshold", "precision", "recall", metric.alias("f1"))
    best = curve.groupBy("model").agg(F.max_by(row, F.struct(metric, -F.col("threshold"))).alias("b"))
    return best.select("model", "b.*")


def threshold_f1(scored: DataFrame) -> DataFrame:
    return _best(pr_curve(scored), f1_of(F.col("precision"), F.col("recall")))


def threshold_precision_floor(scored: DataFrame, floor: float = 0.80) -> DataFrame:
    """Largest recall among thresholds whose precision reaches the floor, else the largest F1."""
    p, r = F.col("precision"), F.col("recall")
    safe = p >= floor
    f1 = f1_of(p, r, True)
    rank = F.struct(safe.cast("int"), F.when(safe, r).otherwise(f1), -F.col("threshold"))
    row = F.struct("threshold", "precision", "recall", safe.cast("int").alias("meets_floor"))
    best = pr_curve(scored).groupBy("model").agg(F.max_by(row, rank).alias("b"))
    return best.select("model", "b.*")


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area with tied scores: every negative counts the positives above it and half of its ties."""
    c = cumulative(scored)
    above = (F.col("tp") - F.col("pos")).cast("double") + F.col("pos") / 2
    out = c.groupBy("model").agg(
        F.max("p").alias("positives"), F.max("n").alias("negatives"), F.sum(above * F.col("neg")).alias("_u")
    )
    area = F.col("_u") / (F.col("positives").cast("double") * F.col("negatives"))
    return out.select("model", "positives", "negatives", area.alias("roc_auc"))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    called = F.col("score") >= threshold
    return scored.groupBy("model").agg(
        F.count_if(called & (F.col("label") == 1)).alias("tp"),
        F.count_if(~called & (F.col("label") == 0)).alias("tn"),
        F.count_if(called & (F.col("label") == 0)).alias("fp"),
        F.count_if(~called & (F.col("label") == 1)).alias("fn"),
    )


def safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def confusion_report(scored: DataFrame, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, and the accuracy."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))

    def line(label: int, hit: Column, false_call: Column, miss: Column) -> Column:
        precision, recall = safe_ratio(hit, hit + false_call), safe_ratio(hit, hit + miss)
        return F.struct(
            F.lit(label).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            safe_ratio(2 * precision * recall, precision + recall).alias("f1"),
            (hit + miss).alias("support"),
            safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        )

    table = confusion(scored, threshold)
    return table.select("model", F.inline(F.array(line(0, tn, fn, fp), line(1, tp, fp, fn))))


def soft_vote(df: DataFrame, columns: list[str], out: str = "score") -> DataFrame:
    """Mean of model probabilities that stand side by side."""
    return df.withColumn(out, sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns))


def soft_vote_tables(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Mean of the scores of separately scored tables: a union and one aggregate, no chain of joins."""
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t)
    return stacked.groupBy(*keys).agg((F.sum("score") / F.count("score")).alias("score"), F.count("score").alias("models"))


def challenger_gate(
    metrics: DataFrame,
    challenger: str,
    champion: str,
    min_gain: float = 0.002,
    min_precision: float = 0.75,
    default_auc: float = 0.858,
) -> DataFrame:
    """One row: promote when the challenger gains enough AUC and keeps its precision. ``metrics`` has one
    row per model; a missing champion takes the default AUC."""
    auc = F.max(F.when(F.col("model") == champion, F.col("roc_auc")))
    row = metrics.agg(
        F.coalesce(auc, F.lit(default_auc)).alias("champion_auc"),
        F.max(F.when(F.col("model") == challenger, F.col("roc_auc"))).alias("challenger_auc"),
        F.max(F.when(F.col("model") == challenger, F.col("precision"))).alias("precision"),
    )
    gain = F.col("challenger_auc") - F.col("champion_auc")
    promoted = (gain >= min_gain) & (F.col("precision") >= min_precision)
    return row.withColumns({"gain": gain, "promoted": F.coalesce(promoted, F.lit(False)).cast("int")})


def retrain_gate(
    audit: DataFrame, runs: DataFrame, today: str, threshold: int = 100, min_samples: int = 50, force: bool = False
) -> DataFrame:
    """One row: whether enough outcomes are resolved and no successful run happened today."""
    from playlens.operators.audit import resolved_count

    done_today = runs.agg(
        F.count_if((F.col("status") == "SUCCESS") & (F.to_date("finished_at") == F.lit(today).cast("date"))).alias("n")
    ).scalar()
    r = F.col("resolved")
    enough = r >= threshold if not force else F.lit(True)
    fresh = F.col("runs_today") == 0 if not force else F.lit(True)
    out = resolved_count(audit).withColumn("runs_today", done_today)
    return out.withColumns(
        {
            "triggered": enough.cast("int"),
            "enough_samples": (r >= min_samples).cast("int"),
            "should_retrain": (enough & fresh & (r >= min_samples)).cast("int"),
        }
    )


def auc_sane(auc: Column, minimum: float = 0.60) -> Column:
    return (auc >= minimum).cast("int")


# --- batch decisions -------------------------------------------------------------------------------
def decide(df: DataFrame, threshold: float, prob: str = "prob") -> DataFrame:
    """Decision, tier, both policies and the explanation; a missing probability degrades to 0.35."""
    p = F.coalesce(F.col(prob), F.lit(X.COLD_START_PROB))
    skip = p >= threshold
    pct = p * 100
    return df.withColumns(
        {
            "skip_probability": X.round_even(p, 4),
            "is_skip_predicted": skip.cast("int"),
            "risk_tier": X.risk_tier_3(p, threshold),
            "cdn_policy": F.when(skip, "JIT_3SEC_CHUNKING (Stop 30s prefetch to save bandwidth)").otherwise("STANDARD_PREFETCH"),
            "recommender_policy": F.when(skip, "SILENT_AUTOPLAY_PURGE (Silently drop track before playback)").otherwise("KEEP_IN_QUEUE"),
            "explanation": F.when(
                skip,
                F.format_string(f"High skip probability (%.1f%%) exceeds SLA threshold ({threshold * 100:.1f}%%).", pct),
            ).otherwise(F.format_string("Safe skip probability (%.1f%%). User is in flow state.", pct)),
        }
    )
