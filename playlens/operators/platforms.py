"""Platform and geography tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import temporal
from playlens.operators.totals import with_total

OUTCOMES = ["Completed", "Skipped", "Other"]


def platform_share(plays: DataFrame) -> DataFrame:
    out = plays.groupBy(X.platform_token("platform").alias("platform")).agg(
        F.count("song_name").alias("plays"), F.sum("sec_played").alias("total_seconds"), F.count(F.lit(1)).alias("_n")
    )
    share = X.percent(F.col("plays"), F.col("_total"), 1)
    return with_total(out, "_n").withColumns({"hours": X.hours("total_seconds"), "percentage": share}).drop("_n", "_total")


def platform_hours(plays: DataFrame) -> DataFrame:
    out = plays.groupBy(X.platform_token("platform").alias("platform")).agg(F.sum("sec_played").alias("seconds"))
    return out.select("platform", X.hours("seconds", 4).alias("total_hours"))


def platform_outcome_ratio(plays: DataFrame) -> DataFrame:
    graded = plays.withColumns({"platform": X.platform_token("platform"), "outcome": X.outcome()})
    wide = graded.groupBy("platform").pivot("outcome", OUTCOMES).agg(F.count(F.lit(1)))
    names = [o.lower() for o in OUTCOMES]
    return temporal.row_normalise(wide.withColumnsRenamed(dict(zip(OUTCOMES, names))), names)


def platform_engagement(plays: DataFrame) -> DataFrame:
    out = plays.groupBy(X.platform_family("platform").alias("platform")).agg(
        F.count(F.lit(1)).alias("plays"), F.sum("sec_played").alias("seconds"), F.sum("skipped").alias("skips")
    )
    return out.select(
        "platform",
        "plays",
        X.round_even(F.col("seconds") / F.col("plays"), 4).alias("mean_seconds"),
        X.percent(F.col("skips"), F.col("plays"), 4).alias("skip_percentage"),
    )


def offline_share(plays: DataFrame) -> DataFrame:
    """Denominator: the rows that carry a label."""
    labelled = plays.withColumn("mode", X.offline_label()).where(F.col("mode").isNotNull())
    out = labelled.groupBy("mode").agg(F.count("song_name").alias("plays"), F.count(F.lit(1)).alias("_n"))
    return with_total(out, "_n").withColumn("percentage", X.percent(F.col("plays"), F.col("_total"), 4)).drop("_n", "_total")
