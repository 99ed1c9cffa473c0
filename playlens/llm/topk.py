"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import task_count

#: Vectors in a block, blocks in a group (one task holds one group of blocks and one of queries), queries in a group.
BLOCK, BLOCKS, QUERIES = 256, 32, 4096
EXACT = 2**53  # sums below it are exact in double, so that the inner products may run as matrix products


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): floor(256 * x) of each component as long. Rows with a null id, a null vector, or a null or non-finite
    component are absent."""
    x = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(x, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda x: F.floor(x * 256).cast("long")).alias("v")
    )


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)  # shorter vectors count as filled with zeros
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _packed(batches):
    """Rows in id order to blocks: ids and the matrix of a range of documents."""
    ids, rows = [], []

    def block():
        m = _matrix(rows, max((len(r) for r in rows), default=0))
        return pd.DataFrame({"ids": [np.array(ids, np.int64).tobytes()], "m": [m.tobytes()], "width": [m.shape[1]]})

    for batch in batches:
        for i, v in zip(batch["id"], batch["v"]):
            ids.append(i), rows.append(v)
            if len(ids) == BLOCK:
                yield block()
                ids, rows = [], []
    if ids:
        yield block()


def _product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if exact else a @ b.T


def best_of_group(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of shape (queries, k), the largest long where there is none, and how many (query, block) pairs were scored.

    The bound of a block for a query is the sum over the components of the largest product that the block's maxima
    and minima allow. Each query meets the blocks by falling bound. It leaves once the next bound is below its k-th
    score; an equal bound is still scored, as a smaller id may tie. Queries at the same block are scored together.
    """
    low, high = np.array([m.min(0) for _, m in blocks]), np.array([m.max(0) for _, m in blocks])
    peak = max(int(np.abs(q).max(initial=0)), 1) * max(int(np.abs(low).max(initial=0)), int(np.abs(high).max(initial=0)), 1) * q.shape[1]
    if peak >= 1 << 63:
        raise OverflowError("inner products of these vectors may pass 64 bits")
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    bound = _product(up, high, peak < EXACT) + _product(down, low, peak < EXACT)
    order = np.argsort(-bound, axis=1, kind="stable")
    none = np.iinfo(np.int64)
    ids, scores = np.full((len(q), k), none.max), np.full((len(q), k), none.min)
    alive, scored = np.arange(len(q)), 0
    for step in range(len(blocks)):
        at = order[alive, step]
        kth = scores[alive, k - 1]
        go = (bound[alive, at] >= kth) | (ids[alive, k - 1] == none.max)
        alive, at = alive[go], at[go]
        if not len(alive):
            break
        for b in np.unique(at):
            who = alive[at == b]
            b_ids, m = blocks[b]
            s = _product(q[who], m, peak < EXACT)
            all_ids = np.concatenate([ids[who], np.broadcast_to(b_ids, s.shape)], 1)
            own = all_ids[:, k:] == q_ids[who][:, None]
            s[own] = none.min
            all_ids[:, k:][own] = none.max
            all_s = np.concatenate([scores[who], s], 1)
            top = np.lexsort((all_ids, -np.maximum(all_s, none.min + 1)), axis=1)[:, :k]
            ids[who], scores[who] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_s, top, 1)
            scored += len(who)
    return ids, scores, scored


_FOUND = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products among the vectors of other
    ids, ties to the smaller id, all if fewer. ``vectors`` and ``queries`` are (id, v) as from ``quantised``.

    Vectors are dealt by id range and packed into blocks of ``BLOCK``; a group of ``BLOCKS`` blocks meets a group of
    ``QUERIES`` queries in one task, so no task or driver holds all of either. Each task prunes by block bounds and
    hands on at most ``k`` rows a query. Repeated ids are separate candidates; query rows that
    share an id are answered together. Vectors so large that a score may pass 64 bits raise OverflowError. The largest long is no id. Shorter vectors count as filled with zeros. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    n, n_q = vectors.count(), queries.count()
    if not n or not n_q:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packed = (
        vectors.repartitionByRange(task_count(spark, n, BLOCK * BLOCKS), "id").sortWithinPartitions("id")
        .mapInPandas(_packed, "ids binary, m binary, width int")
    )
    groups, q_groups = max(1, -(-n // (BLOCK * BLOCKS))), max(1, -(-n_q // QUERIES))
    docs = packed.select(
        F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(q_groups - 1))).alias("q"), "ids", "m", "width"
    )
    asks = queries.distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.xxhash64("id", "v"), F.lit(q_groups)).cast("int").alias("q"), "id", "v"
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(int(left["width"].max()), max(len(v) for v in right["v"]), 1)
        blocks = []
        for ids, m, w in zip(left["ids"], left["m"], left["width"]):
            m = np.frombuffer(m, np.int64).reshape(-1, w) if w else np.zeros((len(ids) // 8, 0), np.int64)
            blocks.append((np.frombuffer(ids, np.int64), np.pad(m, ((0, 0), (0, width - w)))))
        q_ids = right["id"].to_numpy(np.int64)
        ids, scores, _ = best_of_group(q_ids, _matrix(list(right["v"]), width), blocks, k)
        some = ids != np.iinfo(np.int64).max
        return pd.DataFrame({"query_id": np.repeat(q_ids, k)[some.ravel()], "vec_id": ids[some], "score": scores[some]})

    found = docs.groupBy("g", "q").cogroup(asks.groupBy("g", "q")).applyInPandas(meet, _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # cut to k before the shuffle as well
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
