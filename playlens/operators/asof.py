"""As-of join of two tables: each left row with the last right row of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.functions import exprs as X
from playlens.operators.ordered import OrderedRows, r_last
from playlens.operators.sessions import US

_TIME, _SIDE, _LEFT, _RIGHT, _FOUND = "_asof_time", "_asof_side", "_asof_left", "_asof_right", "_asof_found"


def _comparable(df: DataFrame, time: str) -> Column:
    """Times as whole microseconds; numbers as they are."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.DateType):
        return X.micros(F.col(time).cast("timestamp"))
    return X.micros(time) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(time)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    right_on: str | None = None,
    strict: bool = False,
    tolerance: float | None = None,
    prefix: str = "",
    limit: int | None = None,
) -> DataFrame:
    """All rows of ``left``, each with the columns of one row of ``right`` (without ``by``, named with ``prefix``).

    The row found has equal ``by`` and the latest ``right_on`` (default ``on``) that is not after the left row's ``on``, or before
    it if ``strict``. Of right rows with equal keys and times the one with the largest other columns, left to right, is
    found. With ``tolerance`` (seconds for times, else in the unit of ``on``) a row further back than that isn't: columns are
    null, as where nothing is found. A null key or time finds nothing and is never found. Names that clash raise ValueError.

    Both tables meet in one order per key, marked by side, and the last right row is a running value: one exchange of
    each, no pairs. A key that owns much of either table is cut into chunks (see ``OrderedRows``; ``limit``: its rows).
    """
    right_on = right_on or on
    taken = [c for c in right.columns if c not in by]
    clash = sorted({prefix + c for c in taken} & set(left.columns))
    if clash:
        raise ValueError(f"columns of both tables: {clash}; give a prefix")
    known = right.where(F.col(right_on).isNotNull())
    for k in by:
        known = known.where(F.col(k).isNotNull())
    first = [right_on, *[c for c in taken if c != right_on]]
    own = left.select(*by, _comparable(left, on).alias(_TIME), F.lit(0 if strict else 1).alias(_SIDE), F.struct(*left.columns).alias(_LEFT))
    other = known.select(*by, _comparable(right, right_on).alias(_TIME), F.lit(1 if strict else 0).alias(_SIDE), F.struct(_comparable(right, right_on).alias("at"), *first).alias(_RIGHT))
    both = own.unionByName(other, allowMissingColumns=True)
    # left rows of one time see the same right rows, so their order among each other is free
    sized = left.select(*by).unionAll(right.select(*by))
    rows = OrderedRows.by(both, list(by), [_TIME, _SIDE, _RIGHT], limit, sized_by=sized).running({_FOUND: r_last(F.col(_RIGHT))}).rows()
    rows = rows.where(F.col(_LEFT).isNotNull())
    ok = F.col(_TIME).isNotNull()
    if tolerance is not None:
        timed = isinstance(left.schema[on].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        ok &= F.col(_TIME) - F.col(f"{_FOUND}.at") <= (round(tolerance * US) if timed else tolerance)
    return rows.select(f"{_LEFT}.*", *[F.when(ok, F.col(f"{_FOUND}.{c}")).alias(prefix + c) for c in taken])
