"""Skip, shuffle, reason and attention tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators import temporal
from playlens.operators.clean import lump_rare
from playlens.operators.totals import grand_total, with_total


def skip_rate(plays: DataFrame, entity: str, min_plays: int = 15) -> DataFrame:
    out = plays.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.sum("skipped").alias("skip_count"), F.count(F.lit(1)).alias("total_plays")
    )
    out = out.where(F.col("total_plays") >= min_plays)
    return out.withColumn("skip_percentage", X.percent(F.col("skip_count"), F.col("total_plays"), 1))


def flag_rate_by(plays: DataFrame, flag: str, **bucket: Column) -> DataFrame:
    """Share of rows with ``flag`` set per bucket."""
    out = plays.withColumns(bucket).groupBy(*bucket).agg(
        F.sum(flag).alias("hits"), F.count(F.lit(1)).alias("plays")
    )
    return out.withColumn("percentage", X.percent(F.col("hits"), F.col("plays"), 4))


def shuffle_weekend_skip(plays: DataFrame) -> DataFrame:
    weekend = (F.weekday("time_stamp") >= 5).cast("int")
    out = plays.groupBy(weekend.alias("weekend")).agg(
        F.count(F.lit(1)).alias("plays"), F.sum("shuffle").alias("shuffled"), F.sum("skipped").alias("skipped")
    )
    return out.withColumns(
        {
            "shuffle_share": X.percent(F.col("shuffled"), F.col("plays"), 4),
            "skip_rate": X.percent(F.col("skipped"), F.col("plays"), 4),
        }
    )


def value_share(plays: DataFrame, column: str, digits: int = 2, label: str | None = None) -> DataFrame:
    """Value counts with their share of all rows, null rows included in the denominator."""
    out = plays.groupBy(F.col(column).alias(label or column)).agg(F.count(F.lit(1)).alias("plays"), F.count(column).alias("_known"))
    known = with_total(out, "plays").where("_known > 0")
    return known.withColumn("percentage", X.percent(F.col("plays"), F.col("_total"), digits)).drop("_known", "_total")


def lifecycle_matrix(plays: DataFrame, ends: list[str]) -> DataFrame:
    """Start reason x end reason, each row as percentages of its listed ends."""
    known = plays.where(F.col("reason_start").isNotNull() & F.col("reason_end").isNotNull())
    wide = known.groupBy("reason_start").pivot("reason_end", ends).agg(F.count(F.lit(1)))
    return temporal.row_normalise(wide, ends)


def lifecycle_flows(plays: DataFrame, min_share: float = 0.01) -> DataFrame:
    """Edges device -> start -> end with at least ``min_share`` of all rows, nodes numbered by name."""

    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("None"))

    device = F.concat(F.lit("Device: "), X.platform_token("platform"))
    start, end = F.concat(F.lit("Start: "), text("reason_start")), F.concat(F.lit("End: "), text("reason_end"))

    def edge(source: Column, target: Column) -> Column:
        return F.struct(source.alias("source"), target.alias("target"))

    # one pass over the plays: count the few (device, start, end) triples, then split each into two edges
    triples = plays.groupBy(device.alias("a"), start.alias("b"), end.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    both = triples.select("n", F.inline(F.array(edge(F.col("a"), F.col("b")), edge(F.col("b"), F.col("c")))))
    total = grand_total(triples, "n")
    edges = both.groupBy("source", "target").agg(F.sum("n").alias("plays")).where(F.col("plays") >= total * min_share)
    # each side of the flow sums to the table, so at most 2 / min_share edges are left: one short list
    listed = edges.agg(F.collect_list(F.struct("source", "target", "plays")).alias("e"))
    ends = F.flatten(F.transform("e", lambda x: F.array(x["source"], x["target"])))
    numbered = listed.select("e", F.array_sort(F.array_distinct(ends)).alias("nodes"))
    flat = numbered.select(F.inline("e"), "nodes")
    return flat.select(
        "source",
        "target",
        "plays",
        (F.array_position("nodes", F.col("source")) - 1).cast("int").alias("source_id"),
        (F.array_position("nodes", F.col("target")) - 1).cast("int").alias("target_id"),
    )


def distinct_nodes(flows: DataFrame) -> DataFrame:
    """The distinct ends of the flows with their numbers."""
    ends = F.array(
        F.struct(F.col("source").alias("node"), F.col("source_id").alias("node_id")),
        F.struct(F.col("target").alias("node"), F.col("target_id").alias("node_id")),
    )
    return flows.select(F.inline(ends)).distinct()


def attention_span(plays: DataFrame, limit_sec: int = 630) -> DataFrame:
    bounded = plays.where((F.col("reason_end") == X.SKIP_REASON) & (F.col("sec_played") <= limit_sec))
    out = bounded.groupBy(F.year("time_stamp").alias("year")).agg(
        F.sum("sec_played").alias("total_sec"), F.count(F.lit(1)).alias("skip_count")
    )
    return out.withColumn("avg_seconds_before_skip", X.round_even(F.col("total_sec") / F.col("skip_count"), 4))


def quickest_skipped(plays: DataFrame, min_skips: int = 15, exact: bool = True) -> DataFrame:
    """Median seconds of skipped plays per artist. Skips are first counted per (artist, second), so the
    exact median sees one row per distinct whole second, whatever the artist's size."""
    skips = plays.where((F.col("skipped") == 1) & F.col("artist_name").isNotNull())
    per_second = skips.groupBy("artist_name", "sec_played").agg(F.count(F.lit(1)).alias("n"))
    median = (
        F.percentile("sec_played", 0.5, F.col("n")) if exact else F.percentile_approx("sec_played", 0.5, 10000)
    )
    source = per_second if exact else skips.withColumn("n", F.lit(1))
    out = source.groupBy("artist_name").agg(median.cast("double").alias("median_skip_sec"), F.sum("n").alias("total_skips"))
    return out.where(F.col("total_skips") >= min_skips)


def attention_shift(plays: DataFrame, min_plays: int = 30) -> DataFrame:
    """Mean seconds before a skip per (artist, year) and its spread over the artist's years."""
    skipped_sec = F.when(F.col("skipped") == 1, F.col("sec_played"))
    per = plays.groupBy("artist_name", F.year("time_stamp").alias("year")).agg(
        F.count("sec_played").alias("play_counts"),
        F.sum(skipped_sec).alias("_sum"),
        F.count(skipped_sec).alias("_n"),
    )
    per = per.where(F.col("play_counts") >= min_plays).withColumn("avg_time_before_skip", F.col("_sum") / F.col("_n"))
    w = Window.partitionBy("artist_name")  # one row per year
    spread = F.max("avg_time_before_skip").over(w) - F.min("avg_time_before_skip").over(w)
    return per.withColumn("drastic_change", X.round_even(spread, 4)).select(
        "artist_name", "year", "play_counts", X.round_even("avg_time_before_skip", 4).alias("avg_time_before_skip"), "drastic_change"
    )


def skip_thresholds(plays: DataFrame, cuts=(5, 15, 30)) -> DataFrame:
    skips = plays.where(F.col("reason_end") == X.SKIP_REASON)
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return skips.agg(
        F.count(F.lit(1)).alias("skips"),
        *[X.round_even(F.count_if(F.col("sec_played") <= c) / n, 6).alias(f"within_{c}s") for c in cuts],
    )


def skip_cdf(plays: DataFrame) -> DataFrame:
    """Empirical CDF of seconds before a skip: counts per whole second, then a two-level running sum
    (per hour block, then inside the block), so no window spans all rows. Plays without seconds don't count."""
    skips = plays.where((F.col("reason_end") == X.SKIP_REASON) & F.col("sec_played").isNotNull())
    per = skips.groupBy("sec_played").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("sec_played") / 3600))
    blocks = per.groupBy("block").agg(F.sum("n").alias("bn"))
    w = Window.partitionBy(F.lit(0)).orderBy("block")  # one row per hour of play length
    before = blocks.select("block", (F.sum("bn").over(w) - F.col("bn")).alias("before"))
    total = grand_total(per.select("sec_played", "n"), "n")
    inside = F.sum("n").over(Window.partitionBy("block").orderBy("sec_played"))
    out = per.join(before, "block").withColumn("at_most", inside + F.col("before"))
    return out.select("sec_played", F.col("n").alias("skips"), "at_most", X.round_even(F.col("at_most") / total, 6).alias("cdf"))


def bandwidth_by_outcome(plays: DataFrame, mb_per_track: float = X.MB_PER_TRACK) -> DataFrame:
    out = plays.groupBy(X.outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("tracks"))
    return out.withColumn("total_gb", X.round_even(F.col("tracks") * mb_per_track / 1024, 4))


def ui_trigger_breakdown(plays: DataFrame) -> DataFrame:
    return lump_rare(plays, "reason_start", 0.02)


def control_mode_by_hour(plays: DataFrame) -> DataFrame:
    modes = ["Active", "Passive"]
    moded = plays.withColumn("mode", X.control_mode())
    wide = moded.groupBy(F.hour("time_stamp").alias("hour")).pivot("mode", modes).agg(F.count(F.lit(1)))
    return temporal.row_normalise(wide.withColumnsRenamed({m: m.lower() for m in modes}), [m.lower() for m in modes])


def one_hit_wonders(plays: DataFrame, min_plays: int = 1) -> DataFrame:
    """Artists with exactly one distinct song. Equal smallest and largest name is that test without a
    distinct count, so one partial row per artist and task is all that shuffles."""
    per = plays.where(F.col("artist_name").isNotNull()).groupBy("artist_name").agg(
        F.min("song_name").alias("the_one_hit"), F.max("song_name").alias("_last"), F.count(F.lit(1)).alias("total_plays")
    )
    one = per.where((F.col("the_one_hit") == F.col("_last")) & (F.col("total_plays") >= min_plays))
    return one.select("artist_name", "the_one_hit", F.lit(1).alias("unique_songs"), "total_plays")
