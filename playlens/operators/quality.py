"""Schema compaction and row validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_INT_RANGES = [("tinyint", 1 << 7), ("smallint", 1 << 15), ("int", 1 << 31)]
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_NUMERIC = (*_WHOLE, "float", "double")


def compaction_plan(df: DataFrame) -> DataFrame:
    """One row per numeric column: range, nulls, fractions and the narrowest lossless type. Whole numbers are compared as such,
    so the ends of bigint are exact. A single aggregate over the table; the unpivot runs on its one row."""
    entries = []
    for name, kind in df.dtypes:
        if kind not in _NUMERIC:
            continue
        c, low, high = F.col(name).cast("double"), F.min(name), F.max(name)
        fits = F.when(F.lit(False), F.lit(""))
        for type_name, bound in _INT_RANGES:
            fits = fits.when((low >= -bound) & (high < bound), F.lit(type_name))
        wide = F.lit("bigint") if kind in _WHOLE else F.when((low >= -float(1 << 63)) & (high < float(1 << 63)), F.lit("bigint")).otherwise(F.lit("double"))
        fractional = F.count_if(c != F.floor(c)) if kind not in _WHOLE else F.lit(0).cast("bigint")
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                low.cast("double").alias("min_value"),
                high.cast("double").alias("max_value"),
                F.count_if(F.col(name).isNull()).alias("nulls"),
                fractional.alias("fractional"),
                F.when((fractional > 0) | low.isNull(), F.lit("double")).otherwise(fits.otherwise(wide)).alias("target_type"),
            )
        )
    return df.agg(F.array(*entries).alias("s")).select(F.inline("s"))


def compact(df: DataFrame) -> DataFrame:
    """Cast every numeric column to its planned type (one small row per column reaches the driver)."""
    plan = {r["column_name"]: r["target_type"] for r in compaction_plan(df).collect()}
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])


def validate(df: DataFrame, required=(), non_negative=()) -> DataFrame:
    """Adds ``reasons``: the list of broken rules, empty for a valid row."""
    rules = [F.when(F.col(c).isNull() | (F.trim(c) == ""), F.lit(f"missing {c}")) for c in required]
    rules += [F.when(F.col(c) < 0, F.lit(f"negative {c}")) for c in non_negative]
    return df.withColumn("reasons", F.filter(F.array(*rules), lambda r: r.isNotNull()))


def split_valid(df: DataFrame, required=(), non_negative=()) -> tuple[DataFrame, DataFrame]:
    checked = validate(df, required, non_negative)
    ok = F.size("reasons") == 0
    return checked.where(ok).drop("reasons"), checked.where(~ok)
