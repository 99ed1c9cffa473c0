"""Time-ordered train / validation splits and training-set assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.ordered import OrderedRows, r_count
from playlens.session import materialize


def by_year(df: DataFrame, first: int, last_train: int, ts: str = "time_stamp") -> DataFrame:
    """``split``: train up to ``last_train``, test after it; rows before ``first`` are left out."""
    year = F.year(ts)
    return df.where(year >= first).withColumn("split", F.when(year <= last_train, "train").otherwise("test"))


DAY_US, SECOND_US = 86_400_000_000, 1_000_000


def _locate(rows: DataFrame, unit_us: int, target) -> Row | None:
    """The time unit that holds the target row. One row per unit: at most the days of the calendar or the
    seconds of a day, so the window over them is small whatever the table holds."""
    counts = rows.groupBy(F.floor(F.col("t_us") / unit_us).alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    all_units = Window.partitionBy(F.lit(0))
    placed = counts.withColumns(
        {
            "total": F.sum("n").over(all_units),
            "before": F.sum("n").over(all_units.orderBy("unit")) - F.col("n"),
        }
    ).withColumn("target", target(F.col("total")).cast("bigint"))
    hit = (F.col("before") < F.col("target")) & (F.col("before") + F.col("n") >= F.col("target"))
    return placed.where(hit).first()


def nth_in_order(df: DataFrame, target, ts: str = "time_stamp", tie: str = "event_id") -> Row | None:
    """The row at position ``target(total)`` (from 1) in (time, id) order over the whole table.

    Narrowed down instead of ranking everything: the day that holds it, the second of that day, then the
    exact order within the second. Time and id are written once, so that the steps don't read the whole table. Each step sends one row to the driver; None when there is no such row."""
    rows = materialize(df.select(X.micros(ts).alias("t_us"), F.col(tie).alias("event_id")), "order")
    for unit_us in (DAY_US, SECOND_US):
        hit = _locate(rows, unit_us, target)
        if hit is None:
            return None
        lo, rest = hit["unit"] * unit_us, hit["target"] - hit["before"]
        rows = rows.where((F.col("t_us") >= lo) & (F.col("t_us") < lo + unit_us))
        target = lambda _, n=rest: F.lit(n)
    ranked = OrderedRows.by(rows.withColumn("_all", F.lit(0)), ["_all"], ["t_us", "event_id"]).running(
        {"position": r_count(inclusive=True)}
    )
    return ranked.rows().where(F.col("position") == rest).select("t_us", "event_id").first()


def by_position(df: DataFrame, target, ts: str = "time_stamp", tie: str = "event_id") -> DataFrame:
    """Rows up to position ``target(total)`` in time order are train, the rest test. Once the boundary row
    is known this is a plain expression: the table itself is not shuffled."""
    edge = nth_in_order(df, target, ts, tie)
    if edge is None:  # the target is zero or less: nothing to train on
        return df.withColumn("split", F.lit("test"))
    t, i = X.micros(ts), F.col(tie)
    first = (t < edge["t_us"]) | ((t == edge["t_us"]) & (i <= edge["event_id"]))
    return df.withColumn("split", F.when(first, "train").otherwise("test"))


def by_fraction(df: DataFrame, fraction: float, ts: str = "time_stamp", tie: str = "event_id") -> DataFrame:
    return by_position(df, lambda n: F.floor(n * fraction), ts, tie)


def tail(df: DataFrame, ratio: float = 0.15, at_least: int = 500, ts: str = "time_stamp", tie: str = "event_id") -> DataFrame:
    """The last max(``at_least``, ``ratio``) rows in time order are the validation set."""
    return by_position(df, lambda n: n - F.greatest(F.lit(at_least), F.floor(n * ratio)), ts, tie)


def assemble(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """History and audit rows on their shared feature columns; rows with a null feature are dropped."""
    out = None
    for f in frames:
        part = f.select(*[c for c in columns if c in f.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.dropna()


def class_weights(df: DataFrame, label: str = "is_skip") -> DataFrame:
    out = df.agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    return out.withColumn("scale_pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)))


def with_weight(df: DataFrame, scale_pos_weight: float, label: str = "is_skip") -> DataFrame:
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0)))


def order_positions(df: DataFrame, ts: str = "time_stamp", tie: str = "event_id") -> DataFrame:
    """Every row's 1-based position in (time, id) order over the whole table."""
    keyed = df.withColumns({"t_us": X.micros(ts), "_all": F.lit(0)})
    return OrderedRows.by(keyed, ["_all"], ["t_us", tie]).running({"position": r_count(inclusive=True)}).rows().drop("_all", "t_us")
