"""Ordered per-key computations that stay balanced when one key owns much of the table.

A window ``PARTITION BY user`` puts all rows of a user into one task. That is the right plan for
nearly every user and the wrong one for the few that hold a large share of all rows. `OrderedRows`
therefore splits its input by a measured row count:

* *cold* keys (at most ``limit`` rows) use plain windows over one shared hash exchange on the keys;
* *hot* keys are range-partitioned on (keys, order) into chunks of about ``limit / 2`` rows, written
  once so that chunk ids are fixed, and every running value is chunk-local value + carry, where the
  carry is the total of the earlier chunks (one row per key and chunk).

Both paths give the same rows; the split only decides how they are computed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.session import materialize

DEFAULT_HOT_ROWS = 4_000_000
#: Rows that a task should get of the shared exchange. A task sorts them once for each kind of window, all in memory at a time.
TASK_ROWS = 250_000
CHUNK, CARRY = "_chunk", "_carry"
#: Hot keys found lately, per plan and files read. Steers plans only.
_hot_key_memo: OrderedDict[tuple, tuple[list, int]] = OrderedDict()
MEMO_SIZE = 64
#: Lists of hot keys up to this length are broadcast; longer ones are joined as the planner sees fit.
BROADCAST_KEYS = 100_000


def hot_row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("playlens.hot.rows", str(DEFAULT_HOT_ROWS)))


def measured(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[list, int]:
    """(key..., rows) of the keys with more than ``limit`` rows, at most total/limit of them, and the rows of all keys.
    It steers the plan only, never the result. Remembered per input plan and file listing, so rows appended
    to a folder are counted anew."""
    probe = df.select(*keys)
    files = hash(tuple(sorted(df.inputFiles())))
    memo = (df.sparkSession.sparkContext.applicationId, probe.semanticHash(), files, tuple(keys), limit)
    if memo not in _hot_key_memo:
        n = F.col("count")
        counted = probe.groupBy(*keys).count().agg(F.collect_list(F.when(n > limit, F.struct(*keys, n))), F.sum(n)).first()
        _hot_key_memo[memo] = [tuple(r) for r in counted[0]], counted[1] or 0
        while len(_hot_key_memo) > MEMO_SIZE:
            _hot_key_memo.popitem(last=False)
    return _hot_key_memo[memo]


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> list:
    return measured(df, keys, limit)[0]


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The exchange on the keys. Where the cores would get more than `TASK_ROWS` each, it has as many tasks as the rows ask for; the planner
    would join them into larger ones, which are small as they are shuffled and large when they are sorted."""
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df.repartition(*keys)


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, count, max or last; ``inclusive`` adds the current row.

    ``last`` of an expression keeps nulls out, so wrap nullable values in a struct to get a plain lag."""

    kind: str
    value: Column | None = None
    inclusive: bool = False


def r_sum(value: Column, inclusive: bool = False) -> Running:
    return Running("sum", value, inclusive)


def r_count(inclusive: bool = False) -> Running:
    return Running("sum", F.lit(1).cast("bigint"), inclusive)


def r_max(value: Column, inclusive: bool = False) -> Running:
    return Running("max", value, inclusive)


def r_last(value: Column, inclusive: bool = False) -> Running:
    return Running("last", value, inclusive)


def _sort_expr(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


class OrderedRows:
    """Rows of ``df`` grouped by ``keys`` and totally ordered inside a key by ``order`` (a leading
    ``-`` means descending). ``order`` must be unique within a key."""

    def __init__(self, cold: DataFrame, hot: DataFrame | None, keys, order, chunks: int, limit: int, stored: bool):
        self.cold, self.hot = cold, hot
        self.keys, self.order, self.chunks, self.limit = list(keys), list(order), chunks, limit
        self._hot_is_stored = stored

    def _with(self, cold: DataFrame, hot: DataFrame | None, stored: bool = False) -> OrderedRows:
        return OrderedRows(cold, hot, self.keys, self.order, self.chunks, self.limit, stored)

    # -- construction --------------------------------------------------------------------------
    @classmethod
    def by(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        limit: int | None = None,
        sized_by: DataFrame | None = None,
    ) -> OrderedRows:
        """``sized_by``: a frame with the same rows per key that is cheaper to count, such as the table
        before columns were added; its counts are remembered across operators."""
        limit = limit or hot_row_limit(df)
        found, total = measured(df if sized_by is None else sized_by, keys, limit)
        if not found:
            return cls(dealt(df, keys, total), None, keys, order, 0, limit, False)
        spark = df.sparkSession
        schema = df.select(*keys).schema
        mark = spark.createDataFrame([f[:-1] for f in found], schema)  # <= total / limit rows
        match = [F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
        on = reduce(lambda a, b: a & b, match)
        left, right = df.alias("l"), mark.alias("h")
        if len(found) <= BROADCAST_KEYS:
            right = F.broadcast(right)
        cold = left.join(right, on, "left_anti")
        hot = left.join(right, on, "left_semi")
        chunks = max(2, -(-2 * sum(f[-1] for f in found) // limit))
        ranged = hot.repartitionByRange(chunks, *[F.col(k) for k in keys], *[_sort_expr(o) for o in order])
        stored = materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")
        return cls(dealt(cold, keys, total - sum(f[-1] for f in found)), stored, keys, order, chunks, limit, True)

    # -- row-wise steps --------------------------------------------------------------------------
    def map(self, step: Callable[[DataFrame], DataFrame]) -> OrderedRows:
        """Apply a row-wise step to both parts."""
        hot = None if self.hot is None else step(self.hot)
        return self._with(step(self.cold), hot, self._hot_is_stored)

    def with_columns(self, columns: dict[str, Column]) -> OrderedRows:
        return self.map(lambda d: d.withColumns(columns))

    # -- running values --------------------------------------------------------------------------
    def running(self, outputs: dict[str, Running], extra_keys: Sequence[str] = ()) -> OrderedRows:
        return self.running_many([(tuple(extra_keys), outputs)])

    def running_many(self, specs: Sequence[tuple[Sequence[str], dict[str, Running]]]) -> OrderedRows:
        """Add running values for several sub-keys at once. All of them share one exchange: hashing on
        the outer keys (or on the chunk) already clusters every finer grouping."""
        cold = self.cold
        for extra, outputs in specs:
            by = [*self.keys, *extra]
            cold = cold.withColumns({n: self._windowed(r, by) for n, r in outputs.items()})
        hot = None if self.hot is None else self._running_hot(specs)
        return self._with(cold, hot)

    def _windowed(self, r: Running, by: Sequence[str], first: Sequence[Column] = ()) -> Column:
        w = Window.partitionBy(*by).orderBy(*first, *[_sort_expr(o) for o in self.order])
        w = w.rowsBetween(Window.unboundedPreceding, 0 if r.inclusive else -1)
        if r.kind == "sum":
            return F.coalesce(F.sum(r.value).over(w), F.lit(0))
        if r.kind == "max":
            return F.max(r.value).over(w)
        return F.last(r.value, ignorenulls=True).over(w)

    def _running_hot(self, specs) -> DataFrame:
        """The carry of a key enters its chunk as one extra row that sorts before all others, so the plain
        running value over the chunk already includes it: one exchange on the chunk and no join."""
        if not self._hot_is_stored:  # a carry reads the frame again: store it instead of recomputing
            self.hot = materialize(self.hot, "chunks")
            self._hot_is_stored = True
        base, is_row = self.hot, F.col(CARRY).isNull()
        both = base.withColumn(CARRY, F.lit(None).cast("int"))
        for i, (extra, outputs) in enumerate(specs):
            carry = self._carry(base, [*self.keys, *extra], outputs)
            both = both.unionByName(carry.withColumn(CARRY, F.lit(i)), allowMissingColumns=True)
        out = both.repartition(self.chunks, CHUNK)
        for i, (extra, outputs) in enumerate(specs):
            by = [CHUNK, *self.keys, *extra]
            seen = {
                n: Running(r.kind, F.when(is_row, r.value).when(F.col(CARRY) == i, F.col(f"_c_{n}")), r.inclusive)
                for n, r in outputs.items()
            }
            out = out.withColumns({n: self._windowed(r, by, [is_row.asc()]) for n, r in seen.items()})
        return out.where(is_row).drop(CARRY, *[f"_c_{n}" for _, outputs in specs for n in outputs])

    def _carry(self, base: DataFrame, by: Sequence[str], outputs: dict[str, Running]) -> DataFrame:
        """Totals per (key, chunk), then their running value over the earlier chunks of the key."""
        totals = base.groupBy(CHUNK, *by).agg(*[self._total(r).alias(f"_c_{n}") for n, r in outputs.items()])
        before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        merge = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
        carried = totals.withColumns({f"_c_{n}": merge[r.kind](F.col(f"_c_{n}")).over(before) for n, r in outputs.items()})
        return carried.where(reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in outputs]))

    def _total(self, r: Running) -> Column:
        if r.kind == "sum":
            return F.sum(r.value)
        if r.kind == "max":
            return F.max(r.value)
        rank = F.struct(*[F.col(o.lstrip("-")) for o in self.order])
        descending = all(o.startswith("-") for o in self.order)
        pick = F.min_by if descending else F.max_by
        return pick(r.value, F.when(r.value.isNotNull(), rank))

    # -- result ----------------------------------------------------------------------------------
    def rows(self, columns: Sequence[str | Column] | None = None) -> DataFrame:
        parts = [self.cold] + ([] if self.hot is None else [self.hot.drop(CHUNK)])
        parts = [p.select(*columns) if columns else p for p in parts]
        return reduce(lambda a, b: a.unionByName(b), parts)


def lag_struct(*names: str) -> Running:
    """The previous row's columns as a struct; null before the first row."""
    return r_last(F.struct(*[F.col(n) for n in names]))


def time_lookback(
    rows: OrderedRows,
    time_us: str,
    row_id: str,
    flag: str,
    windows_us: dict[str, int],
    last_flag: str,
    flags_before: str,
    extra_keys: Sequence[str] = (),
) -> OrderedRows:
    """Time-based look-back over flagged rows, exact under tied times.

    Adds ``last_flag`` = latest ``time_us`` of a flagged row strictly before this row's time, and per
    entry of ``windows_us`` the flagged rows in (t - W, t] that precede this row in order. The latter is
    a difference of two running counts: ``flags_before`` (all flagged rows before this one, already a
    column) minus the flagged rows with time <= t - W. ``rows.order`` must start with ``time_us``;
    ``extra_keys`` restrict the look-back further, e.g. to a session.
    """
    t = F.col(time_us)
    flagged = F.col(flag) == 1

    def cold_step(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*rows.keys, *extra_keys).orderBy(time_us)
        older = {n: w.rangeBetween(Window.unboundedPreceding, -us) for n, us in windows_us.items()}
        return d.withColumns(
            {last_flag: F.max(F.when(flagged, t)).over(w.rangeBetween(Window.unboundedPreceding, -1))}
            | {
                n: F.col(flags_before) - F.coalesce(F.sum(flag).over(frame), F.lit(0))
                for n, frame in older.items()
            }
        )

    hot = None if rows.hot is None else _time_lookback_hot(
        rows, time_us, row_id, flag, windows_us, last_flag, flags_before, extra_keys
    )
    return rows._with(cold_step(rows.cold), hot)


def _time_lookback_hot(rows, time_us, row_id, flag, windows_us, last_flag, flags_before, extra_keys) -> DataFrame:
    """Events and look-back probes in one ordering. A probe sorts before the events of its own time
    (strict) or after them (window edge), so plain running values answer both kinds."""
    base = rows.hot if rows._hot_is_stored else materialize(rows.hot, "chunks")

    def entry(x: Column, side: int, probe: str, hit: Column) -> Column:
        return F.struct(x.alias("x"), F.lit(side).alias("side"), F.lit(probe).alias("probe"), hit.alias("hit"))

    t, none = F.col(time_us), F.lit(0)
    probes = [entry(t, 1, "", F.col(flag)), entry(t, 0, last_flag, none)]
    probes += [entry(t - us, 2, name, none) for name, us in windows_us.items()]
    both = base.select(*rows.keys, *extra_keys, row_id, F.inline(F.array(*probes)))
    ordered = OrderedRows.by(both, rows.keys, ["x", "side", row_id, "probe"], rows.limit)
    answered = ordered.running(
        {
            "_hits": r_sum(F.col("hit")),
            "_last": r_max(F.when(F.col("hit") == 1, F.col("x"))),
        },
        extra_keys,
    ).rows().where("probe <> ''")
    wide = answered.groupBy(*rows.keys, row_id).agg(
        F.max(F.when(F.col("probe") == last_flag, F.col("_last"))).alias(last_flag),
        *[F.max(F.when(F.col("probe") == n, F.col("_hits"))).alias(f"_le_{n}") for n in windows_us],
    )
    ids = [*rows.keys, row_id]
    answers = wide.select(*[F.col(k).alias(f"_id{i}") for i, k in enumerate(ids)], last_flag, *[f"_le_{n}" for n in windows_us])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_id{i}")) for i, k in enumerate(ids)])  # a null key is a key
    joined = base.join(answers, same).drop(*[f"_id{i}" for i in range(len(ids))])
    return joined.withColumns({n: F.col(flags_before) - F.col(f"_le_{n}") for n in windows_us}).drop(
        *[f"_le_{n}" for n in windows_us]
    )
