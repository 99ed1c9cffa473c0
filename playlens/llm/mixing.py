"""Mixing to target weights with soft membership: posterior domains, rates by projected gradient."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import any_names, checkpointed

#: Labelled rows that the classifier is fitted on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Rounds of the projected gradient at most, and the part of the budget by which a domain may miss its target.
ROUNDS, MISS = 40, 1e-6
TARGETS = {"prime": 0.9, "rough": 0.1}


def features(text: str) -> np.ndarray:
    """Shares of kinds of bytes in a text, as square roots, and the logarithm of its length."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = np.bincount(raw, minlength=256).astype(np.float64)
    kinds = [n[65:91].sum(), n[97:123].sum(), n[48:58].sum(), n[32], n[10], n[9], n[128:].sum(), *n[33:48], *n[58:65], *n[91:97], *n[123:127]]
    return np.r_[np.sqrt(np.array(kinds) / max(len(raw), 1)), np.log1p(len(raw)) / 8]


def fit(x: np.ndarray, y: np.ndarray, domains: int, rounds: int = 400, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression (weights, offsets) by accelerated gradient steps. Without two domains in ``y``: the smoothed
    shares for every text."""
    share = np.bincount(y, minlength=domains) + 1.0
    w, b = np.zeros((x.shape[1], domains)), np.log(share / share.sum())
    if len(np.unique(y)) < 2:
        return w, b
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z, t = np.c_[(x - mean) / scale, np.ones(len(x))], np.eye(domains)[y]
    v = np.r_[w, b[None]]
    step, last = 2 * len(z) / np.linalg.norm(z, 2) ** 2, v.copy()
    for k in range(rounds):
        ahead = v + (v - last) * k / (k + 3)
        p = _softmax(z @ ahead)
        slope = z.T @ (p - t) / len(z)
        slope[:-1] += penalty * ahead[:-1]
        last, v = v, ahead - step * slope
    w = v[:-1] / scale[:, None]
    return w, v[-1] - mean @ w


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _measured(at: int, model=None):
    """The column ``at`` holds the text: instead of it, its number of words, and its features or its posterior."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            x = np.array([features(t) for t in texts]).reshape(len(texts), -1)
            if model is not None and len(texts):
                x = _softmax(x @ model[0] + model[1])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(at)), pa.array([len(t.split()) for t in texts], pa.int64()), pa.array(list(x), pa.list_(pa.float64()))],
                names=[*b.schema.names[:at], "__tokens", "__x"],
            )

    return run


def _rate(moves: list[np.ndarray]) -> Column:
    """A document's rate after the rounds so far: it follows from its posterior and the few numbers of each round, so
    no rates are stored between rounds."""
    r = F.lit(1.0)
    for m in moves:
        r = F.greatest(F.lit(0.0), r - sum((F.col("__x")[i] * float(v) for i, v in enumerate(m)), F.lit(0.0)))
    return r


def solve(posteriors: DataFrame, weights: np.ndarray, budget: float | None) -> list[np.ndarray]:
    """The rounds of the projected gradient for least squares of the domains' expected tokens against their targets.

    ``posteriors`` has ``__tokens`` and ``__x``. With A r the domains' expected tokens at rates r, each round moves all rates against
    the gradient of the squared miss, measured in the inverse of A's second moments over the documents with a rate, and
    cuts them at zero. A round is one aggregate over all documents; the squared number of domains is what comes to the
    driver. A round that comes no nearer is taken back and halved; targets that no rates meet end after ROUNDS.
    """
    d = len(weights)
    x, n = [F.col("__x")[i] for i in range(d)], F.col("__tokens").cast("double")

    def sums(r: Column) -> tuple[np.ndarray, np.ndarray]:
        live = F.when(r > 0, n).otherwise(0.0)
        s = posteriors.agg(*[F.sum(n * r * x[i]) for i in range(d)], *[F.sum(live * x[i] * x[j]) for i in range(d) for j in range(d)]).first()
        return np.array(s[:d], float), np.array(s[d:], float).reshape(d, d)

    now, moment = sums(F.lit(1.0))
    total = float(now.sum())
    if not total > 0:  # no words, or no rows
        return []
    share = np.divide(now / total, weights, out=np.zeros(d), where=weights > 0)
    aim = weights * (total * share.max() if budget is None else budget)
    moves: list[np.ndarray] = []
    miss, scale = (now - aim) / total, np.linalg.pinv(moment / total, rcond=1e-9)
    for _ in range(ROUNDS):
        if np.abs(miss).max() < MISS * aim.sum() / total:
            break
        before, step = miss, scale @ miss
        moves.append(step)
        now, moment = sums(_rate(moves))
        miss = (now - aim) / total
        if miss @ scale @ miss >= before @ scale @ before:  # too far: half of it next time
            moves.pop()
            miss, scale = before, scale / 2
            continue
        scale = np.linalg.pinv(moment / total, rcond=1e-9)
    return moves


@any_names
def mix(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float] = TARGETS, text: str = "text", doc_id: str = "doc_id", budget: float | None = None, sample: int = SAMPLE, seed: int = 7
) -> DataFrame:
    """``docs`` with n_tokens (words), posterior (a probability for each of ``targets``, in their order), rate and copies.

    ``labelled`` is (doc_id, domain). A softmax classifier of byte statistics, fitted on at most ``sample`` labelled rows,
    gives each document's posterior. Rates are nonnegative and near 1; the expected tokens of each domain, the sum of
    rate times tokens times posterior over all documents, meet its target weight (weights are scaled to 1) of ``budget`` tokens
    as nearly as least squares can. Without a budget it is the smallest that thins no domain as a whole. ``copies`` is the
    rate rounded down or up at random by a hash of the row, so that its expectation is the rate.

    Null and empty texts have no tokens and still a rate. Labels of other domains, null ids, and ids that are no document are left
    out; of several labels of an id the first in the alphabet counts. Without labels of two domains all posteriors are equal.
    Repeated rows have equal rates. Two passes over the texts, no shuffle of them.
    """
    domains = list(targets)
    weights = np.array([float(targets[k]) for k in domains])
    weights = weights / weights.sum()
    new = ["n_tokens", "posterior", "rate", "copies"]
    t = F.col(text).cast("string")
    named = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    picked = named.join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = checkpointed(picked.select(F.col("doc_id").cast("long").alias("__id"), "domain"), "picked")
    rows = docs.join(picked, F.col(doc_id) == F.col("__id")).select("__id", "domain", t.alias("t")).mapInArrow(_measured(2), "__id long, domain string, __tokens long, __x array<double>")
    rows = sorted((r["domain"], r["x"]) for r in rows.groupBy("__id", "domain").agg(F.min("__x").alias("x")).collect())  # one a label
    model = fit(np.array([r[1] for r in rows]), np.array([domains.index(r[0]) for r in rows], int), len(domains)) if rows else (np.zeros((len(features("")), len(domains))), np.zeros(len(domains)))
    found = checkpointed(docs.select(t.alias("t")).mapInArrow(_measured(0, model), "__tokens long, __x array<double>"), "posteriors")
    rate = _rate(solve(found, weights, budget))
    keep = [c for c in docs.columns if c not in new]
    full = docs.select(*keep, t.alias("__t"))
    full = full.mapInArrow(_measured(len(keep), model), docs.select(*keep).schema.add("__tokens", "long").add("__x", T.ArrayType(T.DoubleType())))
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), t), F.lit(1 << 30)) / float(1 << 30)
    full = full.withColumn("__rate", rate).withColumn("__copies", F.floor(F.col("__rate") + chance))
    return full.select(*keep, F.col("__tokens").alias("n_tokens"), F.col("__x").alias("posterior"), F.col("__rate").alias("rate"), F.col("__copies").alias("copies"))


def resample(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    return mixed.withColumn("__copy", F.explode(F.expr("array_repeat(1, cast(copies as int))"))).select(*columns)
