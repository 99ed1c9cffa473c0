"""Grouped counts next to their grand total, from one read of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def grand_total(groups: DataFrame, n: str) -> Column:
    """The sum of ``n`` over all groups, as a scalar subquery over the grouped frame itself.

    It asks for every sum the frame has, so that its partial aggregate equals the outer one: Spark then reuses that
    shuffle and scans the input once. The outer plan must use all aggregates too."""
    sums = [f.name for f in groups.schema if isinstance(f.dataType, T.NumericType)]
    return groups.agg(F.struct(*[F.sum(c).alias(c) for c in sums])).scalar()[n]


def with_total(groups: DataFrame, n: str, into: str = "_total") -> DataFrame:
    """``groups`` with the sum of the row count ``n`` over all groups. Filter the groups afterwards, on aggregates: a
    filter on a key moves below the aggregate and then the two shuffles differ."""
    return groups.where(F.col(n) > 0).withColumn(into, grand_total(groups, n))
