"""Language-model scores: bit predictors over hashed contexts, mixed by gated weights and refined; word counts as a base."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import LOWER, UPPER, checkpointed

#: Bytes before a bit's own byte that each predictor sees.
ORDERS = (1, 2, 3, 4, 5)
#: A predictor has 2**bits hashed contexts, a slot for some 64 bytes of training text. The model goes to every task, so no more than
#: MOST_BITS: 20 MB in all. Beyond that contexts share slots; counts still come from all the text.
LEAST_BITS, MOST_BITS, BYTES_A_SLOT = 16, 21, 64
#: Bytes of text between two updates of the contexts (the first, and at most: they double), different places in one step of the weights, and
#: bytes of text in a shard.
FIRST_BLOCK, BLOCK, STEP, SHARD = 1 << 18, 6 << 20, 1 << 15, 12 << 20
#: Bytes of text that are scored at once: what their contexts share is predicted once, but a task holds them all. Scores don't depend on it.
SCORED = 3 << 20
#: Counts that a context has of either bit before it was seen; the same for the refinement; how far a step of the weights goes.
PRIOR, REFINE_PRIOR, RATE = 0.4, 8.0, 0.3
LEAST_CURVE = 1 / 128  # of a bit, for the steps
#: The refinement has a row for each start of a byte and LEVELS - 1 steps of the mixed prediction between -LIMIT and LIMIT (log odds).
LEVELS, LIMIT = 33, 12.0
END = b"\xff"  # in no UTF-8 text: makes the probabilities of all texts add up to one
_SEGMENT = 1 << 13
_PART = 1 << 20  # bytes of text, keys or words that are turned at once
_LONGEST = max(ORDERS)
_GATES = (len(ORDERS) + 1) * 8
_M = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) of each byte of the texts as a number, and where each text starts. A text begins after zeros and ends with END."""
    lead = bytes(_LONGEST)
    raw = np.frombuffer(lead + lead.join(t + END for t in texts), np.uint8)
    key = np.zeros(len(raw) - _LONGEST, np.uint64)
    for k in range(_LONGEST + 1):
        key <<= np.uint64(8)
        key |= raw[k : len(raw) - _LONGEST + k]
    sizes = np.array([len(t) + 1 for t in texts])
    own = np.ones(len(key), bool)  # not the zeros between texts
    starts = np.cumsum(sizes + _LONGEST)[:-1] - _LONGEST
    own[(starts[:, None] + np.arange(_LONGEST)).ravel()] = False
    return key[own], np.cumsum(sizes) - sizes


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, about _PART bytes at a time."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) + 1
        if size >= _PART:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counted_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The different (context, byte) of the texts, sorted, and how often each comes."""
    found, often = [], []
    for part in _parts(texts):
        keys = places(part)[0]
        keys.sort()
        first = _firsts(keys)
        found.append(keys[first])
        often.append(np.diff(np.r_[first, len(keys)]).astype(np.uint32))
    keys, often = np.concatenate(found), np.concatenate(often)
    del found
    order = np.argsort(keys)
    keys = keys[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(often[order], first, dtype=np.uint32)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each different one of the sorted keys begins."""
    fresh = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _parted(keys: np.ndarray) -> np.ndarray:
    """How each of the sorted, different keys differs from the one before: in which bits of the byte; 256 where in the context."""
    out = np.full(len(keys), 256, np.uint16)
    for lo in range(1, len(keys), _PART):
        at = keys[lo : lo + _PART]
        out[lo : lo + _PART] = np.minimum(at ^ keys[lo - 1 :][: len(at)], np.uint64(256))
    return out


def _steps(keys: np.ndarray, parted: np.ndarray, j: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """For bit ``j`` of a byte, STEP different (context, bits before it) at a time: the keys that continue them, where each one's begin
    among these, they themselves, and whether the bit is one for each key. What keys share is predicted once."""
    fresh = np.flatnonzero(parted >= 1 << (8 - j)).astype(np.int32)
    for lo in range(0, len(fresh), STEP):
        at = slice(int(fresh[lo]), int(fresh[lo + STEP]) if lo + STEP < len(fresh) else len(keys))
        first = fresh[lo : lo + STEP] - fresh[lo]
        some = keys[at]
        yield at, first, some[first] >> np.uint64(8 - j), (some >> np.uint64(7 - j)) & np.uint64(1) == 1


def _slots(some: np.ndarray, j: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (context, the ``j`` bits before): these bits after a leading one, and each order's slot."""
    node = (some & np.uint64((1 << j) - 1)) | np.uint64(1 << j)
    slots = np.empty((len(ORDERS), len(some)), np.int32)
    context, x = some >> np.uint64(j), np.empty_like(some)
    above = (node << np.uint64(48)) * _M
    for i, k in enumerate(ORDERS):
        np.bitwise_and(context, np.uint64((1 << 8 * k) - 1), out=x)
        x |= np.uint64(k << 40)
        x *= _M
        x += above
        x >>= np.uint64(64 - bits)
        x += np.uint64(i << bits)
        slots[i] = x
    return node.astype(np.int64), slots


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Mixer:
    """Weights of the predictors, a set for each number of predictors that know their context and each bit of the byte; and the
    refinement: how often a bit was one, by the byte's start and the mixed prediction."""

    def __init__(self, state: np.ndarray | None = None):
        w, a = _GATES * len(ORDERS), 256 * LEVELS
        self.state = np.zeros(2 * w + 2 * a) if state is None else state
        self.weighted, self.curve = (self.state[i * w : (i + 1) * w].reshape(_GATES, len(ORDERS)) for i in (0, 1))
        self.ones, self.all = (self.state[2 * w + i * a : 2 * w + (i + 1) * a] for i in (0, 1))
        self.centre = np.tile(_squash(np.linspace(-LIMIT, LIMIT, LEVELS)), 256)
        self.settle()

    def settle(self) -> None:
        """Weights and refinement from what was gathered, by one task or by many: sums add up."""
        self.weights = (self.weighted + 2.0) / (self.curve + 5.0)  # 0.4 before anything was seen
        self.refined = (self.ones + REFINE_PRIOR * self.centre) / (self.all + REFINE_PRIOR)

    def mixed(self, votes: np.ndarray, node: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(gate, log odds, its place in the refinement, the share of the next place, probability of a one) from the predictors' log odds."""
        gate = np.count_nonzero(votes, axis=0) * 8 + j
        weights = self.weights.T.astype(np.float32)
        x = sum(v * w[gate] for v, w in zip(votes, weights)).astype(np.float64).clip(-LIMIT + 1e-4, LIMIT - 1e-4)
        at = (x + LIMIT) * ((LEVELS - 1) / (2 * LIMIT))
        low = at.astype(np.int64)
        part = at - low
        low += node * LEVELS
        p = 0.5 * _squash(x) + 0.5 * ((1 - part) * self.refined[low] + part * self.refined[low + 1])
        return gate, x, low, part, p

    def learn(self, votes: np.ndarray, gate: np.ndarray, x: np.ndarray, low: np.ndarray, part: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> None:
        p, n = _squash(x), zeros + ones
        # what is as good as certain must not drive the weights: its curvature says next to nothing
        error, bend = ones - n * p, n * np.maximum(p * (1 - p), LEAST_CURVE)
        for i, v in enumerate(votes):
            by_error, by_bend = error * v, bend * v * v
            self.curve[:, i] += np.bincount(gate, by_bend, _GATES)
            # a damped Newton step; kept as weight times curvature, so that tasks' weights average by how much they have seen
            w = self.weights[:, i] + RATE * np.bincount(gate, by_error, _GATES) / (self.curve[:, i] + 5.0)
            self.weighted[:, i] = w * (self.curve[:, i] + 5.0) - 2.0
        self.weights = (self.weighted + 2.0) / (self.curve + 5.0)
        for at, share in ((low, 1 - part), (low + 1, part)):
            self.ones += np.bincount(at, share * ones, len(self.ones))
            self.all += np.bincount(at, share * n, len(self.all))


def _let_go() -> None:
    """Memory that is free goes back to the system, where the C library can do it; else a worker keeps it beside what its next task takes."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)


class Learner:
    """One task's contexts and mixer. Each block of text is predicted from what came before it, then learned."""

    def __init__(self, bits: int):
        self.bits, self.mixer = bits, Mixer()
        self.counts = np.zeros((len(ORDERS) << bits, 2), np.float32)

    def block(self, texts: list[bytes]) -> None:
        keys, times = _counted_places(texts)
        both, parted = self.counts.view(np.complex64)[:, 0], _parted(keys)  # zeros and ones of a slot side by side
        # the steps are made twice: to keep the slots of all of them until the block is predicted would take ten times the keys
        for learned in (False, True):
            for j in range(8):
                for at, first, some, bit in _steps(keys, parted, j):
                    node, slots = _slots(some, j, self.bits)
                    n = times[at].astype(np.float64)
                    ones = np.add.reduceat(np.where(bit, n, 0), first)
                    zeros = np.add.reduceat(n, first) - ones
                    if learned:
                        more = (zeros + 1j * ones).astype(np.complex64)
                        for s in slots:
                            np.add.at(both, s, more)
                    else:
                        c = both[slots]
                        votes = np.log((c.imag + PRIOR) / (c.real + PRIOR))
                        gate, x, low, part, _ = self.mixer.mixed(votes, node, j)
                        self.mixer.learn(votes, gate, x, low, part, zeros, ones)
                        self.mixer.settle()

    def parts(self) -> Iterator[tuple[int, bytes]]:
        """(segment, contents) of what was gathered: the slots in use with their counts, a plane for each byte of a count; then the mixer."""
        whole = self.counts.reshape(-1, _SEGMENT, 2)
        for s in range(len(whole)):
            used = np.flatnonzero(whole[s].any(1))
            if len(used):
                planes = np.ascontiguousarray(whole[s][used].astype(np.uint32)).view(np.uint8).reshape(len(used) * 2, 4).T
                yield s, used.astype(np.uint16).tobytes() + planes.tobytes()
        for i in range(0, len(self.mixer.state), 1024):
            yield len(whole) + i // 1024, self.mixer.state[i : i + 1024].tobytes()


def _learned(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go()
        learner, held, size, most = None, [], 0, FIRST_BLOCK
        for b in batches:
            for t in b.column(0).to_pylist():
                learner = learner or Learner(bits)
                held.append((t or "").encode())
                size += len(held[-1])
                if size >= most:
                    learner.block(held)
                    held, size, most = [], 0, min(2 * most, BLOCK)
        if held:
            learner.block(held)
            held = []
        _let_go()
        for s, data in learner.parts() if learner else ():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([data], pa.binary())], names=["s", "data"])

    return run


def _united(bits: int):
    """Rows come sorted by segment: the sums of each, as log odds of its slots, or as they are for the mixer's."""
    slots = (len(ORDERS) << bits) // _SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def out():
            data = total if now >= slots else np.log((total[:, 1] + PRIOR) / (total[:, 0] + PRIOR)).astype(np.float16)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([data.tobytes()], pa.binary())], names=["s", "data"])

        for b in batches:
            for s, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if s != now:
                    if now is not None:
                        yield out()
                    now, total = s, np.zeros((_SEGMENT, 2)) if s < slots else np.zeros(len(data) // 8)
                if s < slots:
                    n = len(data) // 10
                    used = np.frombuffer(data, np.uint16, n)
                    planes = np.frombuffer(data, np.uint8, offset=2 * n).reshape(4, 2 * n)
                    total[used] += np.ascontiguousarray(planes.T).view(np.uint32).reshape(n, 2)
                else:
                    total += np.frombuffer(data)
        if now is not None:
            yield out()

    return run


class Model:
    """The corpus' model. A text's score depends on the text alone."""

    def __init__(self, bits: int, votes: np.ndarray, state: np.ndarray):
        self.bits, self.votes, self.state = bits, votes, state

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "mixer"}

    def bits_of(self, keys: np.ndarray) -> np.ndarray:
        """How many bits each of the sorted, different (context, byte) takes."""
        if not hasattr(self, "mixer"):  # once a worker
            self.mixer = Mixer(self.state)
        out, parted = np.zeros(len(keys)), _parted(keys)
        for j in range(8):
            for at, first, some, bit in _steps(keys, parted, j):
                node, slots = _slots(some, j, self.bits)
                p = self.mixer.mixed(self.votes[slots].astype(np.float32), node, j)[-1]
                own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(bit)]))
                out[at] -= np.where(bit, np.log2(p)[own], np.log2(1 - p)[own])
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text, whole, with its end."""
        if not texts:
            return np.zeros(0)
        which, starts, kinds, n = [], [], [], 0
        for part in _parts(texts):
            keys, start = places(part)
            own, some = pd.factorize(keys)
            which.append((own + n).astype(np.int32)), starts.append(start), kinds.append(some)
            n += len(some)
        again, different = pd.factorize(np.concatenate(kinds))
        order = np.argsort(different)
        bits = np.empty(len(different))
        bits[order] = self.bits_of(different[order])
        bits = bits[again]
        return np.concatenate([-np.add.reduceat(bits[own], start) for own, start in zip(which, starts)]) * log10(2)


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model of all the texts. Each task predicts and learns its texts block by block; the tasks' context counts are summed up, and their
    weights averaged by the curvature that they have seen. What is gathered follows the input: each task sends the contexts it has
    used. The model itself is bounded by MOST_BITS, whatever the input. No rows give a model that calls all bits even."""
    t = F.col(text).cast("string")
    size = int(docs.agg(F.sum(F.octet_length(t))).first()[0] or 0)
    bits = min(MOST_BITS, max(LEAST_BITS, (size // BYTES_A_SLOT).bit_length()))
    rows = docs.select(t.alias("t")).mapInArrow(_learned(bits), "s long, data binary").repartition("s").sortWithinPartitions("s")
    sums = rows.mapInArrow(_united(bits), "s long, data binary").toArrow()
    votes = np.zeros((len(ORDERS) << bits) // _SEGMENT * _SEGMENT, np.float16)
    state = np.zeros_like(Mixer().state)
    for s, data in zip(sums["s"].to_pylist(), sums["data"].to_pylist()):
        i = s * _SEGMENT - len(votes)
        if i < 0:
            votes[s * _SEGMENT :][:_SEGMENT] = np.frombuffer(data, np.float16)
        else:
            i = (s - len(votes) // _SEGMENT) * 1024
            state[i : i + 1024] = np.frombuffer(data)
    return Model(bits, votes, state)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    """The words, A-Z lower-cased; white space is that of ASCII."""
    return text.translate(_LOWER).split()


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Shard:
    """Documents of one task: their rows, the model's scores, their words as places in the sorted hashes of all words."""

    def __init__(self, n: int):
        self.n, self.rows, self.scores, self.sizes, self.held, self.lens, self.ids, self.bytes = n, [], [], [], [], [], [], 0
        self.numbers = _Numbers()

    def add(self, rows: list[pa.StructArray], held: list[bool], texts: list[bytes], scores: np.ndarray) -> None:
        self.rows += rows
        self.held += held
        self.scores.append(scores)
        for t in texts:
            w = tokens(t)
            self.ids.append(np.fromiter(map(self.numbers.__getitem__, w), np.int32, len(w)))
            self.lens.append(len(w))
            self.sizes.append(len(t))
            self.bytes += len(t)

    def row(self) -> list:
        """Its columns. What it holds is let go on the way."""
        ids, hashes = np.concatenate(self.ids), bytearray()
        for word in self.numbers:
            hashes += xxhash.xxh3_128_digest(word)
        self.ids, self.numbers = [], _Numbers()
        h = np.frombuffer(hashes, ">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((h[:, 1], h[:, 0]))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        ids = place[ids] if len(ids) else ids
        learned = np.repeat(~np.array(self.held, bool), self.lens)
        seen = np.zeros(len(order), np.int64)
        for lo in range(0, len(ids), _PART):
            seen += np.bincount(ids[lo : lo + _PART][learned[lo : lo + _PART]], minlength=len(order))
        planes = lambda x: np.ascontiguousarray(x.astype(np.uint32, copy=False)).view(np.uint8).reshape(-1, 4).T.tobytes()
        rows = pa.concat_arrays(self.rows)
        data = (np.concatenate(self.scores).tobytes(), np.array(self.sizes, np.int64).tobytes(), np.array(self.held, bool).tobytes(), np.array(self.lens, np.int64).tobytes(), planes(ids.view(np.uint32)), h[order].tobytes(), planes(seen))
        return [pa.array([self.n], pa.int64()), pa.array([len(order)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), *map(_one, data)]


def _one(data: bytes) -> pa.Array:
    """A column of one binary value, not copied."""
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int32)), pa.py_buffer(data)])


_SHARD = ["shard", "n_words", "rows", "scores", "sizes", "held", "lens", "ids", "hashes", "seen"]


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _sharded(shared, keep: int, size: int):
    """Columns: those that stay, held out, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go()
        model, task, made = shared.value, TaskContext.get().partitionId(), 0
        now = _Shard(task << 32)
        rows, held, texts, n = [], [], [], 0
        for b in batches:
            own = pa.StructArray.from_arrays([b.column(i) for i in range(keep)], names=[f"c{i}" for i in range(keep)])
            lo = 0
            for i, (h, t) in enumerate(zip(b.column(keep).to_pylist(), b.column(keep + 1).to_pylist())):
                held.append(h), texts.append((t or "").encode())
                n += len(texts[-1])
                if n >= SCORED:
                    now.add([*rows, own.slice(lo, i + 1 - lo)], held, texts, model.score(texts))
                    lo, rows, held, texts, n = i + 1, [], [], [], 0
                    if now.bytes >= size:
                        yield pa.RecordBatch.from_arrays(now.row(), names=_SHARD)
                        made += 1
                        now = _Shard((task << 32) + made)
                        _let_go()
            if lo < len(own):
                rows.append(own.slice(lo))
        if texts:
            now.add(rows, held, texts, model.score(texts))
        if now.lens:
            yield pa.RecordBatch.from_arrays(now.row(), names=_SHARD)

    return run


def _dealt(bins: int):
    """Columns (shard, hashes, seen): a row for each bin of a shard's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, hashes, seen in zip(*(b.column(k).to_pylist() for k in range(3))):
                h, seen = np.frombuffer(hashes, np.uint64).reshape(-1, 2), _unplaned(seen)
                at = (((h[:, 0] >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
                cut = np.r_[np.flatnonzero(np.diff(at, prepend=-1)), len(at)]
                rows = [(int(at[i]), shard, h[i:j].tobytes(), seen[i:j].tobytes()) for i, j in zip(cut[:-1], cut[1:])]
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["bin", "shard", "h", "c"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bin. Out: for each shard the corpus counts of its words of the bin; and once a bin their sum and number."""

    def out(now: int, held: list) -> pa.RecordBatch:
        h = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for _, x, _ in held])
        c = np.concatenate([np.frombuffer(x, np.uint32) for _, _, x in held]).astype(np.int64)
        order = np.lexsort((h[:, 1], h[:, 0]))
        fresh = np.r_[True, (h[order][1:] != h[order][:-1]).any(1)]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        total = np.bincount(which, c).astype(np.int64)
        counts = np.split(total[which], np.cumsum([len(x) // 16 for _, x, _ in held])[:-1])
        shards, data = [s for s, _, _ in held] + [None], [x.tobytes() for x in counts] + [None]
        none = [None] * len(held)
        columns = [pa.array([now] * len(shards), pa.int64()), pa.array(shards, pa.int64()), pa.array(data, pa.binary())]
        sums = [pa.array([*none, int(total.sum())], pa.int64()), pa.array([*none, int((total > 0).sum())], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, *sums], names=["bin", "shard", "counts", "total", "kinds"])

    now, held = None, []
    for b in batches:
        for at, shard, h, c in zip(*(b.column(k).to_pylist() for k in range(4))):
            if at != now:
                if held:
                    yield out(now, held)
                now, held = at, []
            held.append((shard, h, c))
    if held:
        yield out(now, held)


NEW = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shard: int = SHARD, bin_words: int = 1 << 20) -> DataFrame:
    """``docs`` without its text, and with (columns of these names are replaced):

    * ``held_out``: crc32 of the id as text is 2 modulo 7; nothing is learned from these rows. A null id is not held out
    * ``score``: log10 of the probability that the model gives to the whole text and its end; ``bits_per_byte``: the same in bits for each byte
    * ``n_tokens``: words (A-Z lower-cased, parted by ASCII white space) and one end; ``n_known``: those that the learned rows hold;
      ``train_tokens``: tokens of all learned rows
    * ``base_score``: the sum over tokens of log10((c + 1) / (N + V + 1)), c how often the learned rows hold the token, N ``train_tokens``, V the
      different ones among them

    Null and empty texts have the end only. Repeated rows score alike, and count each time in what is learned. Without learned rows N and V
    are 0 and all bits are even.

    The texts are read twice: to learn (see ``train``) and to score. Words travel as 128-bit hashes, once for each shard of about
    ``shard`` bytes, to the bin that counts them, and their corpus counts travel back; a bin is about ``bin_words`` entries. Shards
    are written to the shared folder.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs.where(~held_out(F.col(doc_id))), text))
    keep = [c for c in docs.columns if c != text and c not in NEW]
    kind = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)])
    schema = T.StructType().add("shard", "long").add("n_words", "long").add("rows", T.ArrayType(kind))
    for name in _SHARD[3:]:
        schema.add(name, "binary")
    own = docs.select(*keep, held_out(F.col(doc_id)).alias("h"), F.col(text).cast("string").alias("t"))
    shards = checkpointed(own.mapInArrow(_sharded(model, len(keep), shard), schema), "lm-shards")
    entries = int(shards.agg(F.sum("n_words")).first()[0] or 0)
    bins = min(1 << 31, -(-entries // bin_words) or 1)
    words = shards.where("n_words > 0").select("shard", "hashes", "seen").mapInArrow(_dealt(bins), "bin long, shard long, h binary, c binary")
    words = words.repartition("bin").sortWithinPartitions("bin")
    counts = checkpointed(words.mapInArrow(_counted, "bin long, shard long, counts binary, total long, kinds long"), "lm-words")
    n, v = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    learned = docs.where(~held_out(F.col(doc_id))).count()
    n, v = n + learned, v + (learned > 0)
    back = counts.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("bin", "counts")).alias("counts"))
    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    out = T.StructType([*fields]).add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double").add("bits_per_byte", "double")
    joined = shards.select("shard", "rows", "scores", "sizes", "held", "lens", "ids").join(back, "shard", "left")
    return joined.mapInArrow(_finished(n, v, learned, len(keep), out.names), out)


def _finished(n: int, v: int, learned: int, keep: int, names: list[str]):
    """Columns (shard, rows, scores, sizes, held, lens, ids, counts): a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                scores, sizes, held, lens, ids = (b.column(k)[i].as_py() for k in range(2, 7))
                parts = sorted((r["bin"], r["counts"]) for r in b.column(7)[i].as_py() or ())
                counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, np.int64) for _, c in parts)])
                scores, sizes, lens, ids = np.frombuffer(scores), np.frombuffer(sizes, np.int64), np.frombuffer(lens, np.int64), _unplaned(ids)
                often, logs = counts > 0, np.log10(counts + 1.0)
                ends, lo, known, base = np.cumsum(lens), 0, [], []
                while lo < len(lens):  # documents of about _PART words at a time
                    begin = int(ends[lo] - lens[lo])
                    hi = max(lo + 1, int(np.searchsorted(ends, begin + _PART, side="right")))
                    own = ids[begin : ends[hi - 1]]
                    doc = np.repeat(np.arange(hi - lo), lens[lo:hi])
                    known.append(np.bincount(doc, often[own], hi - lo).astype(np.int64))
                    base.append(np.bincount(doc, logs[own], hi - lo))
                    lo = hi
                known = np.concatenate(known) + (learned > 0)
                base = np.concatenate(base) + log10(learned + 1) - (lens + 1) * log10(n + v + 1)
                rows = b.column(1)[i].values
                columns = [rows.field(k) for k in range(keep)]
                columns += [pa.array(np.frombuffer(held, bool)), pa.array(lens + 1), pa.array(known), pa.array(np.full(len(lens), n, np.int64)), pa.array(base), pa.array(scores), pa.array(-scores / log10(2) / (sizes + 1))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        _let_go()

    return run
