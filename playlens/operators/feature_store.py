"""Features of new plays from what earlier plays left behind, without reading those plays again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions import exprs as X
from playlens.operators.features import ENTITY_KEYS, MATRIX_WINDOWS, labelled, matrix_columns, matrix_names, momentum_columns, seconds_since
from playlens.operators.ordered import TASK_ROWS, OrderedRows, hot_row_limit, r_last, r_max, r_sum, time_lookback
from playlens.operators.sessions import US
from playlens.session import materialize

NEW, TAIL, USER = "new", "tail", "user"
#: Before all times: what is carried sorts ahead of a user's plays.
_FIRST = -(1 << 62)
BATCH = "batch"


class FeatureStore:
    """The feature matrix of a history that arrives in batches, each later in every user's (time, id) order than those before.

    Under ``path`` lie ``features``, a folder a batch, and ``carry``, what the next batch needs, a folder a batch too:

    * a row a user: plays, skips and the number of the last skip among the plays;
    * a row for each user and artist, song, genre, album or start reason: plays and skips;
    * a user's last play, and the skips that a window of the next play may still reach.

    A batch reads its own plays and the last carry. That grows with the users and their entities, not with the plays: only
    carry rows of the batch's users are shuffled. A batch that runs again overwrites its own folders. Rows equal ``feature_matrix`` over
    the whole history.
    """

    def __init__(self, spark: SparkSession, path: str, extra_windows_sec: dict[str, int] | None = None):
        self.spark, self.path = spark, path
        self.windows = {**MATRIX_WINDOWS, **(extra_windows_sec or {})}

    def features(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/features").drop(BATCH)

    def carry(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/carry/{batch}")

    def append(self, plays: DataFrame, batch: int) -> DataFrame:
        """Features of the plays of batch ``batch`` (0, 1, ...). Plays that don't lie after a user's earlier ones raise ValueError, and
        nothing is stored."""
        fresh = labelled(plays).select(
            "user_id", "event_id", "time_stamp", X.micros("time_stamp").alias("t_us"), "is_skip", "platform", "shuffle", *ENTITY_KEYS.values()
        )
        carry = self.carry(batch - 1) if batch else None
        if carry is not None and self._late(fresh, carry):
            raise ValueError(f"batch {batch} holds plays that are no later than plays of an earlier batch")
        told = materialize(self._told(fresh, carry, plays), "feature-batch")
        out = f"{self.path}/features/{BATCH}={batch}"
        told.select(*matrix_names(list(self.windows))).write.mode("overwrite").parquet(out)
        self._carried(told, carry).write.mode("overwrite").parquet(f"{self.path}/carry/{batch}")
        return self.spark.read.parquet(out)

    @staticmethod
    def _late(fresh: DataFrame, carry: DataFrame) -> bool:
        at = F.struct("t_us", "event_id")
        last = carry.where(F.col("_kind") == TAIL).groupBy(F.col("user_id").alias("_user")).agg(F.max(at).alias("last"))
        first = fresh.groupBy("user_id").agg(F.min(at).alias("first"))
        both = first.join(last, F.col("user_id").eqNullSafe(F.col("_user")))
        return both.where("first <= last").limit(1).count() > 0

    def _told(self, fresh: DataFrame, carry: DataFrame | None, plays: DataFrame) -> DataFrame:
        rows = fresh.withColumn("_kind", F.lit(NEW))
        if carry is not None:
            users = fresh.select(F.col("user_id").alias("_user")).distinct()
            known = carry.join(users, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")
            named = {k: F.when(F.col("_kind") == n, F.col("key")) for n, k in ENTITY_KEYS.items()}
            rows = rows.unionByName(known.withColumns(named).drop("key"), allowMissingColumns=True)
        else:
            rows = rows.withColumns({c: F.lit(None).cast("long") for c in ("plays", "skips", "last_skip_index")})
        kind = F.col("_kind")
        is_play = kind.isin(NEW, TAIL)
        sized = rows.select("user_id") if carry is not None else plays

        def sums(of: str) -> tuple[Column, Column]:
            new = kind == NEW
            return (F.when(kind == of, F.col("plays")).when(new, 1).otherwise(0), F.when(kind == of, F.col("skips")).when(new, F.col("is_skip")).otherwise(0))

        def history(name: str, prefix: str) -> dict:
            n, s = sums(name)
            return {f"{prefix}past_plays": r_sum(n.cast("long")), f"{prefix}past_skips": r_sum(s.cast("long"))}

        flag = F.when(is_play, F.col("is_skip")).otherwise(0)
        limit = min(hot_row_limit(rows), TASK_ROWS)  # eight windows sort a user's rows, each in memory
        ordered = OrderedRows.by(rows.withColumn("is_skip", flag), ["user_id"], ["t_us", "event_id"], limit, sized).running_many(
            [
                *[((key,), history(name, f"{name}_")) for name, key in ENTITY_KEYS.items()],
                ((), {**history(USER, ""), "_flags": r_sum(F.col("is_skip")), "_prev": r_last(F.when(is_play, F.struct("t_us", "event_id", "is_skip")))}),
            ]
        )
        index = F.when(kind == USER, F.col("last_skip_index")).when((kind == NEW) & (F.col("is_skip") == 1), F.col("past_plays") + 1)
        ordered = ordered.running({"_last_skip_index": r_max(index)})
        ordered = time_lookback(ordered, "t_us", "event_id", "is_skip", {n: s * US for n, s in self.windows.items()}, "last_skip_us", "_flags")
        out = ordered.with_columns(momentum_columns()).with_columns({"seconds_since_last_skip": seconds_since(F.col("t_us"), F.col("last_skip_us"))})
        out = out.with_columns(matrix_columns()).map(lambda d: d.where(kind == NEW))
        return out.rows([*matrix_names(list(self.windows)), "t_us", "past_plays", *ENTITY_KEYS.values()])

    def _carried(self, told: DataFrame, carry: DataFrame | None) -> DataFrame:
        """The carry after a batch: (user_id, _kind, key, event_id, t_us, is_skip, plays, skips, last_skip_index)."""
        none = lambda kind: F.lit(None).cast(kind)
        one, skip = F.count(F.lit(1)).alias("plays"), F.sum("is_skip").cast("long").alias("skips")
        index = F.max(F.when(F.col("is_skip") == 1, F.col("past_plays") + 1)).alias("last_skip_index")
        per_user = told.groupBy("user_id").agg(one, skip, index).select("user_id", F.lit(USER).alias("_kind"), none("string").alias("key"), "plays", "skips", "last_skip_index")
        listed = F.explode(F.array(*[F.struct(F.lit(n).alias("_kind"), F.col(k).cast("string").alias("key")) for n, k in ENTITY_KEYS.items()])).alias("e")
        per_entity = told.select("user_id", "is_skip", listed).groupBy("user_id", "e._kind", "e.key").agg(one, skip, none("long").alias("last_skip_index"))
        sums = per_user.unionByName(per_entity)
        tail = told.select("user_id", "event_id", "t_us", "is_skip")
        if carry is not None:
            sums = sums.unionByName(carry.where(F.col("_kind") != TAIL).select(*sums.columns))
            tail = tail.unionByName(carry.where(F.col("_kind") == TAIL).select(*tail.columns))
        sums = sums.groupBy("user_id", "_kind", "key").agg(F.sum("plays").alias("plays"), F.sum("skips").alias("skips"), F.max("last_skip_index").alias("last_skip_index"))
        sums = sums.select("*", none("long").alias("event_id"), F.lit(_FIRST).alias("t_us"), F.lit(0).alias("is_skip"))
        at = F.struct("t_us", "event_id")
        ends = tail.groupBy("user_id").agg(F.max(at).alias("_last"))
        skips = F.when(F.col("is_skip") == 1, F.col("t_us"))
        same = lambda name: F.col("user_id").eqNullSafe(F.col(name))
        dated = tail.join(ends.select(F.col("user_id").alias("_u"), "_last"), same("_u")).drop("_u")
        # strictly before the last play: a next play at the same time looks back beyond the skips of that time
        before = dated.groupBy("user_id").agg(F.max(F.when(skips < F.col("_last.t_us"), skips)).alias("_before"))
        dated = dated.join(before.select(F.col("user_id").alias("_v"), "_before"), same("_v"))
        widest = max(self.windows.values()) * US
        reach = (F.col("is_skip") == 1) & ((F.col("t_us") > F.col("_last.t_us") - widest) | F.coalesce(F.col("t_us") >= F.col("_before"), F.lit(False)))
        kept = dated.where(reach | (at == F.col("_last"))).select("user_id", "event_id", "t_us", "is_skip", F.lit(TAIL).alias("_kind"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sums, kept])

