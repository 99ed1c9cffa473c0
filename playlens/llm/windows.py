"""Repeated byte windows: a depth-limited radix sort of the suffixes, a digit a pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import any_names, checkpointed

#: Bytes of the first digit of a suffix. Shorter digits meet by chance more often, longer ones make more runs.
DIGIT = 128
#: Different contents of one first digit that one task sorts. Those of a larger group are dealt one by one.
GROUP = 50_000
_PART = 1 << 20  # bytes hashed at once; places in a part and its overlap fit into 22 bits
_PLACE = np.uint64((1 << 22) - 1)
_B = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (modulo 2**64), and a random number for each byte."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        _POWERS["up"] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _B, np.uint64)])
        _POWERS["down"] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(_B, -1, 1 << 64), np.uint64)])
        _POWERS["byte"] = np.random.default_rng(400).integers(1, 2**63, 256, np.uint64) << np.uint64(1) | np.uint64(1)
    return _POWERS["up"], _POWERS["down"], _POWERS["byte"]


def rolled(data: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of each ``width`` bytes of ``data``, equal for equal bytes wherever they stand."""
    up, down, byte = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * up[: len(data)], out=total[1:])
    h = (total[width:] - total[: len(total) - width]) * down[: len(total) - width]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` keys in a row."""
    n = len(keys)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = keys
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(data: bytes, starts: np.ndarray, sizes: np.ndarray, width: int, digit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, first digit) of each run in ``data``, which holds documents at ``starts``.

    The first digit of a window's suffix is the 64-bit hash of its least gram of ``digit`` bytes, the leftmost of
    equal ones. It depends on the window's bytes alone, so equal windows have equal digits, and windows in a row
    mostly share the place of theirs: a run is a maximal row of windows in one document with one such place.
    """
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < width:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    h = rolled(raw, digit)
    place = _least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), width - digit + 1) & _PLACE
    valid = np.zeros(len(place) + 1, np.int8)
    some = sizes >= width
    np.add.at(valid, starts[some], 1)
    np.add.at(valid, (starts + sizes - width + 1)[some], -1)
    valid = np.cumsum(valid[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    first = np.flatnonzero(fresh)
    stop = ~valid | fresh
    ends = np.r_[np.flatnonzero(stop), len(place)]
    after = ends[np.searchsorted(ends, first, side="right")]
    return first, after - first, h[place[first].astype(np.int64)]


def _parts(texts: list[bytes], width: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, sizes, row numbers, places in the row) of pieces that share all windows out, each about _PART long."""
    held, rows, at, size = [], [], [], 0
    for row, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - width + 1), _PART):
            piece = t[lo : lo + _PART + width - 1]
            if len(piece) < width:
                continue
            held.append(piece), rows.append(row), at.append(lo)
            size += len(piece)
            if size >= _PART:
                yield _joined(held, rows, at)
                held, rows, at, size = [], [], [], 0
    if held:
        yield _joined(held, rows, at)


def _joined(held, rows, at):
    sizes = np.array([len(p) for p in held])
    return b"".join(held), np.cumsum(sizes) - sizes, sizes, np.array(rows), np.array(at)


def _emit_runs(width: int, digit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = b.column(0), b.column(1)
            for data, starts, sizes, rows, at in _parts([(t or "").encode() for t in b.column(2).to_pylist()], width):
                first, n, g = runs(data, starts, sizes, width, digit)
                which = np.searchsorted(starts, first, side="right") - 1
                c = np.array([xxhash.xxh3_64_intdigest(data[f : f + k + width - 1]) for f, k in zip(first.tolist(), n.tolist())], np.uint64)
                # a text that repeats itself has thousands of equal runs: one row for all equal ones of a document
                order = np.lexsort((first, c, g, which))
                first, n, g, c, which = first[order], n[order], g[order], c[order], which[order]
                head = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (g[1:] != g[:-1]) | (c[1:] != c[:-1])]) if len(first) else order
                places = pa.array((first - starts[which] + at[which]).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(x.take(pa.array(rows[which[head]])) for x in (ids, th)),
                        pa.ListArray.from_arrays(pa.array(np.r_[head, len(first)].astype(np.int32)), places),
                        pa.array(n[head].astype(np.int32)), pa.array(g[head].view(np.int64)), pa.array(c[head].view(np.int64)),
                    ],
                    names=["id", "th", "a", "n", "g", "c"],
                )

    return run


_PIECES = "hot boolean, g long, id long, th long, a long, n int, own boolean, data binary"


def _emit_pieces(width: int):
    """The bytes of the asked runs; of those in large groups a digest for each window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for i, th, t, asked in zip(*(b.column(k).to_pylist() for k in range(4))):
                t = t.encode()
                for r in asked:
                    if r["hot"]:
                        out += [(True, r["g"], i, th, r["a"] + j, 1, r["own"], xxhash.xxh3_128_digest(t[r["a"] + j : r["a"] + j + width])) for j in range(r["n"])]
                        size += 64 * r["n"]
                    else:
                        out.append((False, r["g"], i, th, r["a"], r["n"], r["own"], t[r["a"] : r["a"] + r["n"] + width - 1]))
                        size += r["n"] + width
                    if size > 1 << 24:
                        yield _pieces(out)
                        out, size = [], 0
            if out:
                yield _pieces(out)

    return run


def _pieces(rows: list) -> pa.RecordBatch:
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["hot", "g", "id", "th", "a", "n", "own", "data"])


def _emit_repeats(width: int):
    """Rows come sorted by their first digit. The suffixes of some whole groups are ordered by the bytes to ``width``
    at a time; equal ones are neighbours."""

    def found(rows: list[tuple]) -> pa.RecordBatch | None:
        data = b"".join(r[5] for r in rows)
        raw = np.frombuffer(data, np.uint8)
        sizes = np.array([len(r[5]) for r in rows])
        starts = np.cumsum(sizes) - sizes
        windows = np.array([r[3] for r in rows])
        at = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        # two unlike hashes of the bytes, and the first digit: the rest of the sort key
        h, r = rolled(raw, width)[at], rolled(raw[::-1], width)[::-1][at]
        g = np.repeat(np.array([x[0] for x in rows], np.int64), windows)
        order = np.lexsort((r, h, g))
        same = (g[order][1:] == g[order][:-1]) & (h[order][1:] == h[order][:-1]) & (r[order][1:] == r[order][:-1])
        again = np.zeros(len(order) + 1, bool)
        again[:-1][order[1:][same]] = True
        again[:-1][order[:-1][same]] = True
        out = []
        for (_, i, th, n, a, _, own), lo in zip(rows, (np.cumsum(windows) - windows).tolist()):
            if own and (hit := again[lo : lo + n]).any():
                edge = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8), 0]))
                out += [(i, th, a + int(s), a + int(e) + width - 1) for s, e in zip(edge[::2], edge[1::2])]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["id", "th", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for g, i, th, n, a, data, own in zip(*(b.column(k).to_pylist() for k in range(7))):
                if size > 1 << 22 and rows[-1][0] != g:
                    if (out := found(rows)) is not None:
                        yield out
                    rows, size = [], 0
                rows.append((g, i, th, n, a, data, own))
                size += len(data)
        if rows and (out := found(rows)) is not None:
            yield out

    return run


def _cut(at: int):
    """The column ``at`` holds the text, the one after it the removed ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for t, ranges in zip(b.column(at).to_pylist(), b.column(at + 1).to_pylist()):
                t = (t or "").encode()
                left, end, spans = [], 0, 0
                for s, e in sorted((r["s"], r["e"]) for r in ranges or ()):
                    if s > end or not spans:
                        left.append(t[end:s])
                        spans += 1
                    end = max(end, e)
                left.append(t[end:])
                whole = b"".join(left)
                kept.append(whole), n_bytes.append(len(t)), n_removed.append(len(t) - len(whole)), n_spans.append(spans)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(at)), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans))],
                names=[*b.schema.names[:at], "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return run


@any_names
def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 400, digit: int = DIGIT, group: int = GROUP) -> DataFrame:
    """``docs`` without its text, and with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).

    Every byte of the UTF-8 text that lies in a window of ``width`` bytes which also starts anywhere else, in the same or
    another row, is removed. Windows don't cross rows. Null counts as empty. Repeated rows repeat all their windows.

    A radix sort of all suffixes through ``width`` bytes, in passes; a suffix goes on to the next pass only while
    others share its digits. To shuffle a digit for each byte of the corpus would take over ten times its size, so
    suffixes travel in runs (see ``runs``):
    1. by first digit, a row for some hundred windows: a run whose digit no other run has is done, nothing in it repeats;
    2. by the hash of the whole run: a run with an equal one is done, all of it repeats;
    3. of runs that share their first digit only, one of each content is ordered window by window, in the task of its
       digit or, if over ``group`` contents share it, dealt by a 128-bit digest of each window.
    Equal groups after the last pass are exactly the repeated windows (by hashes of 128 bits or more together).
    Digits that very many runs share are summed up before each shuffle, and split by the skew join.
    """
    own_id, t = F.col(doc_id).cast("long"), F.col(text).cast("string")
    whole = docs.select(own_id.alias("id"), F.xxhash64(t).alias("th"), t.alias("t"))
    every = checkpointed(whole.mapInArrow(_emit_runs(width, digit), "id long, th long, a array<long>, n int, g long, c long"), "runs")
    many = F.sum(F.size("a"))
    groups = every.groupBy("g").agg(many.alias("k"), (F.min("c") != F.max("c")).alias("mixed")).where("k > 1").select("g", "mixed")
    some = checkpointed(every.join(checkpointed(groups, "digits"), "g"), "shared-runs")
    counts = some.groupBy("g", "c").agg(many.alias("k"), F.max("mixed").alias("mixed"), F.min(F.struct("id", "th", F.get("a", F.lit(0)).alias("a"), "n")).alias("one"))
    counts = checkpointed(counts, "contents")
    twice = checkpointed(counts.where("k > 1").select("g", "c"), "equal-runs")
    equal = some.join(twice, ["g", "c"]).select("id", "th", F.explode("a").alias("s"), "n").select("id", "th", "s", (F.col("s") + F.col("n") + (width - 1)).alias("e"))
    mixed = counts.where("mixed")
    hot = mixed.groupBy("g").agg((F.count(F.lit(1)) > group).alias("hot"))
    asked = mixed.join(checkpointed(hot, "large-digits"), "g").select("one.id", "one.th", F.struct("one.a", "one.n", "g", "hot", (F.col("k") == 1).alias("own")).alias("r"))
    asked = asked.groupBy("id", "th").agg(F.collect_list("r").alias("asked"))
    asked = asked.select(F.col("id").alias("i"), F.col("th").alias("h"), "asked")
    at = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("h"))
    pieces = whole.join(asked, at).select("id", "th", "t", "asked").mapInArrow(_emit_pieces(width), _PIECES)
    pieces = checkpointed(pieces, "pieces")
    dealt = pieces.where("not hot").repartition("g").sortWithinPartitions("g").select("g", "id", "th", "n", "a", "data", "own")
    cold = dealt.mapInArrow(_emit_repeats(width), "id long, th long, s long, e long")
    large = pieces.where("hot")
    again = large.groupBy("data").count().where("count > 1").select("data")
    split = large.where("own").join(checkpointed(again, "windows"), "data").select("id", "th", F.col("a").alias("s"), (F.col("a") + width).alias("e"))
    ranges = equal.unionByName(cold).unionByName(split).groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("__ranges"))
    ranges = ranges.select(F.col("id").alias("__id"), F.col("th").alias("__th"), "__ranges")
    new = ("kept", "n_bytes", "n_removed", "n_spans")
    keep = [c for c in docs.columns if c not in (text, *new)]
    joined = docs.select(*keep, t.alias("__t"), F.xxhash64(t).alias("__own")).join(ranges, (F.col("__own") == F.col("__th")) & own_id.eqNullSafe(F.col("__id")), "left")
    schema = joined.select(*keep).schema.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return joined.select(*keep, "__t", "__ranges").mapInArrow(_cut(len(keep)), schema)
