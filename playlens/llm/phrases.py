"""Phrase collocations: frequent phrases by mining shards one by one (SON), scored by how their parts stick together."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import LOWER, UPPER, checkpointed

#: Bytes of text in a shard: what one task mines in memory. A longer text goes on in the next shard, cut between two pieces.
SHARD = 2 << 20
#: Parts that a lang's phrases are ranked in before the best of each are ranked together.
PARTS = 64
#: Phrases of a bin, about: what one task holds while it sums up the shards' counts.
BIN = 1 << 20
# What parts a text into pieces, and what parts a piece into words.
PIECE_ENDS, WORD_ENDS = ".,;:!?\n\v\f\r", " \t"
# The products may pass 64 bits, not 38 digits.
SCORE = "(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
_TABLE = bytes.maketrans((UPPER + PIECE_ENDS + "\t").encode(), (LOWER + "\n" * len(PIECE_ENDS) + " ").encode())
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Numbers(dict):
    """Numbers words in the order in which they come. An empty word is -2 and the end of a piece -1."""

    def __init__(self):
        super().__init__({b"": -2, b"\n": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 2
        return n


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Words of pieces as numbers, -1 between pieces; and the words."""
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")), np.int32)
    return ids[ids != -2], list(numbers)[2:]


def packed(ids: np.ndarray) -> bytes:
    """The lower two bytes of the numbers plus one, then the upper two: these are nearly all zero and take no room once compressed."""
    return np.ascontiguousarray((ids + 1).astype("<u4").view("<u2").reshape(-1, 2).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int32)
    return (low | high << 16) - 1


def _shards(size: int):
    """Texts of one task by lang, in shards: (shard, lang, n, ids, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def row(lang: str) -> pa.RecordBatch:
            nonlocal made
            ids, words = numbered(b"\n".join(held.pop(lang)))
            sizes.pop(lang)
            made += 1
            kinds = [("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("ids", pa.binary()), ("words", pa.list_(pa.binary()))]
            values = [(task << 32) + made - 1, lang, int((ids >= 0).sum()), packed(ids), words]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(values, kinds)], names=[k for k, _ in kinds])

        for b in batches:
            for lang, text in zip(*(b.column(k).to_pylist() for k in (0, 1))):
                raw = (text or "").encode()
                while raw:
                    part, raw = raw, b""
                    if len(part) > size:  # the last end of a piece within the size, else the first one after it
                        flat = part.translate(_TABLE)
                        cut = flat.rfind(b"\n", 0, size)
                        cut = cut if cut >= 0 else flat.find(b"\n", size)
                        if cut >= 0:
                            part, raw = part[:cut], part[cut + 1 :]
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= size:
                        yield row(lang)
        for lang in list(held):
            yield row(lang)

    return run


def _rows(b: pa.RecordBatch) -> Iterator[list]:
    """One at a time: rows of shards are large."""
    for i in range(b.num_rows):
        yield [c[i].as_py() for c in b.columns]


def _hashed(lang: str, ids: np.ndarray, words: list[bytes], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a phrase, places where one starts, their 64-bit hashes). Equal phrases of a lang have equal hashes in all shards."""
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang))
    places, h = np.flatnonzero(ids >= 0), None
    for n in range(1, longest + 1):
        if n > 1:  # phrases that go on
            go = places + n - 1 < len(ids)
            places, h = places[go], h[go]
            go = ids[places + n - 1] >= 0
            places, h = places[go], h[go]
        word = own[ids[places + n - 1]] if len(places) else np.zeros(0, np.uint64)
        h = (np.full(len(places), seed) if h is None else h) * np.uint64(_MIX[0]) + word
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX[1])
        h ^= h >> np.uint64(32)
        yield n, places, h


def _mined(longest: int, support: int):
    """One row a shard and bin: the phrases that are frequent in the shard, as the low halves of their hashes, each with its count
    less what it could have unseen. Columns: (shard, lang, ids, words, n, total, bins)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, lang, ids, words, n, total, bins in _rows(b):
                least = lowered(support, n, total)
                every = np.concatenate([h for _, _, h in _hashed(lang, unpacked(ids), words, longest)])
                u, count = np.unique(every, return_counts=True)
                some = count >= least
                u, count = u[some], np.minimum(count[some] - (least - 1), support).astype(np.uint8 if support < 256 else np.uint32)
                at = binned(u, bins)
                cut = np.r_[np.flatnonzero(np.diff(at, prepend=-1)), len(u)]
                rows = [(at[i], u[i:j].astype(np.uint32).tobytes(), count[i:j].tobytes()) for i, j in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))],
                    names=["lang", "bin", "shard", "h", "c"],
                )

    return run


def lowered(support: int, n: int, total: int) -> int:
    """The support in a shard of ``n`` of ``total`` words. All shards' supports less one add up to less than ``support``: a phrase that is
    frequent in no shard isn't frequent."""
    return max(1, -(-support * n // max(total, 1)))


def binned(h: np.ndarray, bins: int) -> np.ndarray:
    """Bins go up with the hash."""
    return (((h >> np.uint64(32)) * np.uint64(min(bins, 1 << 31))) >> np.uint64(32)).astype(np.int64)


def _united(support: int):
    """Rows come sorted by (lang, bin); columns (lang, bin, shard, h, c, slack, large). Out: for each shard the phrases of a bin that may be frequent
    in all. A large shard has a lowered support above 1: it may hold phrases that it didn't send, and is asked for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if support < 256 else np.uint32
        now, held = None, []

        def out():
            slack, large = held[0][3] or 0, held[0][4] or []
            h = np.concatenate([np.frombuffer(x, np.uint32) for _, x, _, _, _ in held])
            who = np.repeat(np.arange(len(held)), [len(x) // 4 for _, x, _, _, _ in held])
            c = np.concatenate([np.frombuffer(x, kind) for _, _, x, _, _ in held]).astype(np.int64)
            u, at = np.unique(h, return_inverse=True)
            may = np.bincount(at, c, len(u)) + slack >= support
            parts = np.split(h[may[at]], np.cumsum(np.bincount(who[may[at]], minlength=len(held)))[:-1])
            rows = [(held[i][0], now[1], part.tobytes()) for i, part in enumerate(parts) if len(part) and held[i][0] not in large]
            rows += [(shard, now[1], u[may].tobytes()) for shard in large if may.any()]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["shard", "bin", "h"])

        for b in batches:
            for lang, at, shard, h, c, slack, large in zip(*(b.column(k).to_pylist() for k in range(7))):
                if now != (lang, at):
                    if held:
                        yield out()
                    now, held = (lang, at), []
                held.append((shard, h, c, slack, large))
        if held:
            yield out()

    return run


def _counted(longest: int):
    """Columns (lang, ids, words, bins, asked): the exact counts in the shard of the phrases asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, ids, words, bins, asked in _rows(b):
                want = {r["bin"]: np.frombuffer(r["h"], np.uint32) for r in asked}
                keys = np.sort(np.concatenate([(np.uint64(k) << np.uint64(32)) | h.astype(np.uint64) for k, h in want.items()]))
                ids = unpacked(ids)
                for n, places, h in _hashed(lang, ids, words, longest):
                    key = (binned(h, bins).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
                    places = places[keys[np.searchsorted(keys, key).clip(max=len(keys) - 1)] == key]
                    if not len(places):
                        continue
                    code = ids[places].astype(np.int64)  # phrases of this shard in numbers, one word more at a time
                    for k in range(1, n):
                        _, code = np.unique(code, return_inverse=True)
                        code = code * len(words) + ids[places + k]
                    _, first, count = np.unique(code, return_index=True, return_counts=True)
                    text = [b" ".join([words[i] for i in ids[p : p + n].tolist()]).decode() for p in places[first].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(text), pa.string()), pa.array(text, pa.string()), pa.array([n] * len(text), pa.int32()), pa.array(count.astype(np.int64))],
                        names=["lang", "phrase", "words", "a"],
                    )

    return run


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, support: int = 10, shard: int = SHARD, bin_size: int = BIN) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a): all phrases of 1 to ``longest`` words that occur ``support`` times or more in the texts of a lang,
    with their exact counts; and (lang, n): the words of each lang.

    A-Z are lower-cased. ``PIECE_ENDS`` part a text into pieces, spaces and tabs a piece into words; a phrase is a row of words
    within a piece. A null lang is ``und``; null and empty texts hold nothing. Repeated rows count each time.

    SON in three passes over shards of about ``shard`` bytes, which are written once to the shared folder:
    1. Each shard is mined alone and completely, at the support lowered in proportion to its share of the lang's words
       (with very many shards it is 1). A phrase travels as half a hash and a small count.
    2. The union of what is frequent somewhere, in bins by hash: a phrase is a candidate unless the shards that sent it and
       those that didn't can't add up to the support. Unlike phrases that share a hash are both candidates.
    3. Each shard counts the candidates it holds by their words, and the counts are summed up by phrase.
    A bin and a shard fit a task whatever the input; a phrase found everywhere has one entry a shard.
    """
    own = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    shards = checkpointed(own.mapInArrow(_shards(shard), "shard long, lang string, n long, ids binary, words array<binary>"), "shards")
    bins = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("n") * longest / bin_size)).alias("bins")
    totals = checkpointed(shards.groupBy("lang").agg(F.sum("n").alias("total"), bins), "words")
    unseen = F.expr(f"greatest(1, ({support} * n + total - 1) div greatest(total, 1)) - 1")
    unseen = shards.select("shard", "lang", "n").join(totals, "lang").select("lang", "shard", unseen.alias("u")).where("u > 0")
    unseen = unseen.groupBy("lang").agg(F.sum("u").alias("slack"), F.collect_list("shard").alias("large"))  # fewer shards than the support
    slacks = checkpointed(totals.select("lang").join(unseen, "lang", "left"), "slack")
    mined = shards.join(totals, "lang").select("shard", "lang", "ids", "words", "n", "total", "bins").mapInArrow(_mined(longest, support), "lang string, bin long, shard long, h binary, c binary")
    dealt = mined.join(slacks, "lang").select("lang", "bin", "shard", "h", "c", "slack", "large").repartition("lang", "bin").sortWithinPartitions("lang", "bin")
    asked = dealt.mapInArrow(_united(support), "shard long, bin long, h binary")
    asked = checkpointed(asked.groupBy("shard").agg(F.collect_list(F.struct("bin", "h")).alias("asked")), "candidates")
    counted = shards.join(totals, "lang").join(asked, "shard").select("lang", "ids", "words", "bins", "asked").mapInArrow(_counted(longest), "lang string, phrase string, words int, a long")
    found = counted.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= support)
    return checkpointed(found, "phrases"), totals.select("lang", F.col("total").alias("n"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, support: int = 10, absorb: int = 50, top: int = 2000, shard: int = SHARD, bin_size: int = BIN) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first ``top`` phrases of 2 to ``longest`` words by score, then count, then
    phrase (UTF-8 bytes). ``frequent`` says what a phrase is; no texts give no rows.

    Cutting a phrase that occurs ``a`` times after k words leaves a first part that occurs ``l`` times and a rest that occurs ``r`` times;
    the cut scores floor(1000000 * a * a / (l * r)), in decimals of 38 digits. The lowest cut counts, of equal ones the
    first. A phrase goes if a longer frequent phrase holds it and occurs ``absorb`` percent as often or more.
    """
    found, totals = frequent(docs, text, lang, longest, support, shard, bin_size)
    longer = found.where("words >= 2")
    words = F.split("phrase", " ", -1)
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    cuts = longer.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": part(F.lit(1), F.col("k")), "right": part(F.col("k") + 1, F.col("words") - F.col("k"))})
    known = lambda side, name: found.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))  # noqa: E731  a part occurs as often as the whole, at least
    cuts = cuts.join(known("left", "l"), ["lang", "left"]).join(known("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(SCORE))
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.score", "c.l", "c.r")
    holds = [longer.where(F.col("words") > n).select("lang", "a", "words", "phrase", F.explode(F.sequence(F.lit(1), F.col("words") - n + 1)).alias("at")).select("lang", "a", part(F.col("at"), F.lit(n)).alias("held")) for n in range(2, longest)]
    if holds:
        over = reduce(DataFrame.unionAll, holds).groupBy("lang", "held").agg(F.max("a").alias("most"))
        best = best.join(over.select(F.col("lang").alias("of"), "held", "most"), (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("held")), "left")
        best = best.where(F.coalesce(100 * F.col("most").cast("decimal(20,0)") < absorb * F.col("a").cast("decimal(20,0)"), F.lit(True)))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = best.withColumn("rank", place("lang", part)).where(F.col("rank") <= top)
    first = first.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
