"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from math import log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import any_names, checkpointed

#: Labelled rows that are learned from, at most (those with the smallest hash of their id). All their words count.
SAMPLE = 16_384
#: The share of examples from which a word is common.
COMMON = 1 / 8
#: Examples in a block of the index, nearest examples that vote, and the weight of the share of toxic examples beside them: all votes
#: of distant examples together weigh less, so that they don't make a score that says more than is known.
BLOCK, NEAREST, SHRINK = 64, 15, 4.0
#: Texts that are searched at once.
TOGETHER = 64
#: Texts whose scores a worker remembers: copies are searched for once.
REMEMBERED = 16_384
_ONE = float(1 << 47)
_PART = 1 << 18  # postings that are packed at once
REJECT = 0.3
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def evidence_for(hits: np.ndarray, others: np.ndarray, base: float) -> np.ndarray:
    """How surely words are over-represented in toxic texts: the signed root of the likelihood ratio of ``hits`` toxic and ``others`` clean
    texts against the share ``base``; zero if their share isn't above it. It grows with the number of texts at any base."""
    n = np.maximum(hits + others, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log(x / (n * share)), 0.0) for x, share in ((hits, base), (others, 1 - base))]
    return np.where(hits > n * base, np.sqrt(2 * np.maximum(sum(parts), 0.0)), 0.0)


class Index:
    """Labelled examples with all their words, in blocks of ``BLOCK``; examples whose heaviest common word is the same lie together, so that a
    block is of one language. For each word: its postings; for each common word also its largest weight in each block (the block
    maxima)."""

    def __init__(self, idf: dict[str, float], examples: list[tuple], none: float, some: float, rest: dict[str, float] | None = None):
        """``idf``: the weights of the words that speak for toxicity, ``rest``: those of the others. ``examples``: (id, label, counts), the counts
        by word, or as arrays of word numbers (places in ``idf``, then ``rest``) and counts. ``none``, ``some``: the share of toxic texts
        without and with a word that speaks."""
        self.idf, self.none, self.some = idf, none, some
        self.number = {w: i for i, w in enumerate([*idf, *(rest or {})])}
        self.weights = np.array([*idf.values(), *(rest or {}).values()], np.float64)
        examples = sorted(examples, key=lambda e: e[0])
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.labels = np.array([e[1] for e in examples], np.float64)
        self.blocks = max(1, -(-len(examples) // BLOCK))
        each = [self.unit(*(self.numbered(e[2]) if isinstance(e[2], dict) else e[2])) for e in examples]
        word = np.concatenate([np.zeros(0, np.int32), *(k for k, _ in each)])
        weight = np.concatenate([np.zeros(0), *(x for _, x in each)])
        example = np.repeat(np.arange(len(each), dtype=np.int32), [len(k) for k, _ in each])
        n = len(each)
        del each
        self.at = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(self.weights)))])
        often = np.flatnonzero(np.diff(self.at)[word] > COMMON * n)
        often = often[np.lexsort((weight[often], example[often]))]
        last = often[np.flatnonzero(np.diff(example[often], append=-1))]
        heaviest = np.full(n, -1, np.int32)
        heaviest[example[last]] = word[last]
        self.order = np.argsort(heaviest, kind="stable")  # the number of the example at each place
        place = np.empty(n, np.int32)
        place[self.order] = np.arange(n)
        by_word = np.argsort(word, kind="stable").astype(np.int32)
        self.example, self.weight = place[example[by_word]], weight[by_word]
        self.ready, self.known = False, {}

    def _common(self) -> None:
        """The common words' weights in all examples, their block maxima and each example's length in them; made where the search runs."""
        words = np.flatnonzero(np.diff(self.at) > COMMON * len(self.ids))
        self.row = np.full(len(self.weights), -1)
        self.row[words] = np.arange(len(words))
        self.whole = np.zeros((len(words), self.blocks * BLOCK))
        # a posting in one number, so that a word's postings lie in one place: the example, and its weight to 14 digits
        self.packed = self.example.astype(np.uint64)
        self.packed <<= np.uint64(48)
        for lo in range(0, len(self.packed), _PART):
            self.packed[lo : lo + _PART] |= np.rint(self.weight[lo : lo + _PART] * _ONE).astype(np.uint64)
        for r, w in enumerate(words):
            self.whole[r, self.example[self.at[w] : self.at[w + 1]]] = self.weight[self.at[w] : self.at[w + 1]]
        self.example = self.weight = None  # all that they say is in the others now
        self.top = self.whole.reshape(len(words), self.blocks, BLOCK).max(2)
        self.whole = np.ascontiguousarray(self.whole.T)
        self.size = np.sqrt((self.whole**2).sum(1)).reshape(self.blocks, BLOCK)
        self.ready = True

    def numbered(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((self.number[w], n) for w, n in counts.items() if w in self.number)
        return np.array([k for k, _ in found], np.int32), np.array([n for _, n in found], np.int32)

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """``numbered`` of a text's words."""
        counts = Counter(words(text))
        ids = np.fromiter(map(self.number.get, counts, repeat(-1)), np.int32, len(counts))
        order = np.argsort(ids)[np.count_nonzero(ids < 0) :]
        return ids[order], np.fromiter(counts.values(), np.int32, len(counts))[order]

    def unit(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (1 + np.log(counts)) * self.weights[numbers]
        return numbers, x / sqrt(x @ x) if len(x) else x

    def vector(self, counts: dict[str, int]) -> dict[str, float]:
        words = sorted((w for w in counts if w in self.number), key=self.number.get)
        return dict(zip(words, self.unit(*self.numbered(counts))[1].tolist()))

    def nearest(self, v: dict[str, float], k: int = NEAREST) -> tuple[list[tuple[float, int]], int]:
        """``closest`` to a vector by word, and the blocks scored."""
        found = sorted((self.number[w], x) for w, x in v.items())
        best, scored = self.closest([(np.array([i for i, _ in found], np.int32), np.array([x for _, x in found]))], k)
        return best[0], scored

    def closest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST) -> tuple[list[list[tuple[float, int]]], int]:
        """The ``k`` examples with the highest cosine to each vector (word numbers, weights), ties to the smaller id, as (cosine, number); and
        the blocks scored for them together.

        The postings of the rarer words are summed up for all examples. The common words add at most the sum of the query's weights times
        the block maxima, and at most the product of both lengths. Each vector's best block by that bound is scored first, which gives
        a k-th cosine to beat; then the blocks whose bound reaches it for some vector, for all vectors at once. Cosines count to
        nine digits, so that equal ones tie."""
        if not self.ready:
            self._common()
        n, k = len(self.ids), min(k, len(self.ids))
        places = self.blocks * BLOCK
        sums, common = np.zeros((len(vectors), places)), np.zeros((len(vectors), self.whole.shape[1]))
        for i, (numbers, x) in enumerate(vectors):
            rows = self.row[numbers]
            rare = rows < 0
            first = self.at[numbers[rare]]
            size = self.at[numbers[rare] + 1] - first
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            postings = self.packed[at]
            weight = (postings & np.uint64((1 << 48) - 1)) * np.repeat(x[rare] / _ONE, size)
            sums[i] = np.bincount((postings >> np.uint64(48)).view(np.int64), weight, places)
            common[i, rows[~rare]] = x[~rare]
        sums[:, n:] = -1
        blocks = sums.reshape(len(vectors), self.blocks, BLOCK)
        length = np.sqrt((common**2).sum(1))[:, None, None]
        bound = (blocks + np.minimum((common @ self.top)[:, :, None], length * self.size)).max(2)
        cosines = np.full((len(vectors), places), -1.0)
        left, least = np.ones(self.blocks, bool), np.full(len(vectors), -1.0)
        for first in (True, False):
            now = np.unique(bound.argmax(1)) if first else np.flatnonzero(((bound + 1e-8 >= least[:, None]) & left).any(0))
            runs = np.split(now, np.flatnonzero(np.diff(now) != 1) + 1) if len(now) else []
            for run in runs:  # blocks beside each other
                lo, hi = run[0] * BLOCK, min((run[-1] + 1) * BLOCK, n)
                cosines[:, lo:hi] = sums[:, lo:hi] + common @ self.whole[lo:hi].T
            left[now] = False
            if first:
                found = np.concatenate([cosines[:, r[0] * BLOCK : (r[-1] + 1) * BLOCK] for r in runs], 1)
                if found.shape[1] >= k:
                    least = np.partition(found, found.shape[1] - k, 1)[:, found.shape[1] - k]
        out = []
        for row, low in zip(cosines[:, :n], least):
            maybe = np.flatnonzero(row >= low - 2e-9)
            if len(maybe) > 4 * k:
                maybe = maybe[row[maybe] >= np.partition(row[maybe], len(maybe) - k)[len(maybe) - k] - 2e-9]
            numbers, values = self.order[maybe], np.round(row[maybe], 9)
            best = np.lexsort((numbers, -values))[:k]
            out.append(list(zip(values[best].tolist(), numbers[best].tolist())))
        return out, int((~left).sum())

    def voted(self, found: list[tuple[float, int]], share: float) -> tuple[float, list[tuple[int, float, int]]]:
        """The score, and the evidence: (id, cosine, label) of the voters. A voter weighs the more the nearer it is."""
        found = [(c, i) for c, i in found if c > 0]
        weight = np.array([c * c / (0.1 + 1 - c) for c, _ in found])
        label = self.labels[[i for _, i in found]]
        score = (float(weight @ label) + SHRINK * share) / (float(weight.sum()) + SHRINK)
        return min(1.0, max(0.0, score)), [(int(self.ids[i]), c, int(self.labels[i])) for c, i in found]

    def score_all(self, texts: list[str | None]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        """(score, evidence) of each text. Texts alike in their heaviest common word are searched together."""
        if not self.ready:
            self._common()
        out: list = [(self.none, [])] * len(texts)
        asked = []
        for i, t in enumerate(texts):
            numbers, n = self.counted(t)
            if len(numbers) and len(self.ids):
                numbers, x = self.unit(numbers, n)
                often = np.flatnonzero(self.row[numbers] >= 0)
                asked.append((numbers[often[x[often].argmax()]] if len(often) else -1, i, numbers, x))
        asked.sort(key=lambda a: a[:2])
        for lo in range(0, len(asked), TOGETHER):
            some = asked[lo : lo + TOGETHER]
            for (_, i, numbers, _), found in zip(some, self.closest([a[2:] for a in some])[0]):
                out[i] = self.voted(found, self.some if numbers[0] < len(self.idf) else self.none)
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([words(t) for t in b.column(3).to_pylist()], pa.list_(pa.string()))], names=["id", "y", "th", "w"])


class Numbers:
    """The numbers of known words (their places), in 12 bytes a word: a task would hold far more as a dictionary. The words' hashes all differ, so
    it is exact for known words, and only for them."""

    def __init__(self, words: list[str]):
        for self.seed in range(64):
            h = self._hashes(words)
            self.order = np.argsort(h).astype(np.int32)
            self.hashes = h[self.order]
            if (self.hashes[1:] != self.hashes[:-1]).all():
                return
        raise ValueError("words must differ")

    def _hashes(self, words: Iterable[str]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), self.seed) for w in words], np.uint64)

    def of(self, words: Iterable[str]) -> np.ndarray:
        return self.order[np.searchsorted(self.hashes, self._hashes(words))]


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Index:
    """The index, from at most ``sample`` labelled rows that aren't held out, with all their words. Equal texts count once (the largest label).

    Some words speak for toxicity: their ``evidence_for`` it is more than chance gives the best of as many words, whatever the
    share of toxic texts among all. They weigh what others do, but a text that holds one starts from another share of toxic texts. A word counts in as many toxic texts as it has different neighbours there, so that
    copies of one text do not make its words speak. What comes to the driver are the words of the sample and their counts.
    """
    fine = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    picked = fine.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id", "left_semi")
    picked = checkpointed(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").cast("long").alias("__id"), "y"), "picked")
    t = F.col(text).cast("string")
    texts = docs.join(picked, F.col(doc_id) == F.col("__id")).select("__id", "y", F.xxhash64(t).alias("th"), t.alias("t"))
    texts = texts.mapInArrow(_sequences, "id long, y int, th long, w array<string>").groupBy("th").agg(F.max("y").alias("y"), F.min("id").alias("id"), F.min("w").alias("w"))
    texts = checkpointed(texts, "examples")
    n, toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    base = (toxic + 1) / (n + 2)
    per_word = texts.select("y", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("hits"))
    counted = per_word.toArrow().sort_by("word")
    every, df, hits = counted["word"].to_pylist(), counted["n"].to_numpy(), counted["hits"].to_numpy()
    bar = sqrt(2 * log(max(len(every), 2)))  # what the best of so many words that say nothing comes to
    maybe = np.flatnonzero(evidence_for(hits, df - hits, base) > bar)
    around = texts.where("y = 1").select(F.explode(F.transform("w", lambda x, i: F.struct(x.alias("word"), F.get("w", i - 1).alias("l"), F.get("w", i + 1).alias("r")))).alias("x")).select("x.*")
    asked = docs.sparkSession.createDataFrame([(every[i],) for i in maybe], "word string")
    ways = {r["word"]: r["k"] for r in around.join(F.broadcast(asked), "word").groupBy("word").agg(F.count_distinct(F.struct("l", "r")).alias("k")).collect()} if len(maybe) else {}
    distinct = np.array([ways.get(every[i], 0) for i in maybe], np.int64)
    speaks = evidence_for(np.minimum(hits[maybe], distinct), (df - hits)[maybe], base)
    plain = np.log((n + 1) / (df + 0.5)) + 0.1
    idf = {every[i]: float(plain[i]) for i, g in zip(maybe, speaks) if g > bar}
    rest = {w: x for w, x in zip(every, plain.tolist()) if w not in idf}
    number = docs.sparkSession.sparkContext.broadcast(Numbers([*idf, *rest]))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for ws in b.column(2).to_pylist():
                counts = Counter(ws)
                ids = number.value.of(counts)
                order = np.argsort(ids)
                found.append((ids[order].tobytes(), np.fromiter(counts.values(), np.int32, len(counts))[order].tobytes()))
            two = [pa.array([f[j] for f in found], pa.binary()) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *two], names=["id", "y", "words", "counts"])

    rows = texts.select("id", "y", "w").mapInArrow(numbers, "id long, y int, words binary, counts binary").toArrow()
    read = lambda c: [np.frombuffer(x, np.int32) for x in rows[c].to_pylist()]
    examples = [(i, y, (k, c)) for i, y, k, c in zip(rows["id"].to_pylist(), rows["y"].to_pylist(), read("words"), read("counts"))]
    parts = [[e[1] for e in examples if (len(e[2][0]) > 0 and e[2][0][0] < len(idf)) == has] for has in (False, True)]
    none, some = ((sum(ys) + base) / (len(ys) + 1) for ys in parts)
    return Index(idf, examples, none, some, rest)


@any_names
def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE, evidence: str | None = "evidence") -> DataFrame:
    """``docs`` with held_out, score (0 to 1), predicted (1 if the score is at least 0.3) and the evidence, an array of
    (doc_id, cosine, label) of the nearest examples. Columns of these names are replaced.

    ``labels`` is (doc_id, toxic); only rows whose crc32 of the id as text is not 2 modulo 4 are learned from, and only the text
    makes the score. Texts without a word of the sample, null and empty ones too, score the share of toxic texts among examples without
    a word that speaks (without any examples: one half). Repeated rows score alike. Null ids are not held out.
    The index is bounded by the sample and the same for all tasks; the texts are read once more and never shuffled.
    """
    index = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, text, doc_id, sample))
    new = ["held_out", "score", "predicted", *([evidence] if evidence else [])]
    keep = [c for c in docs.columns if c not in new]
    kind = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.IntegerType())]))
    schema = docs.select(*keep).schema.add("__score", "double")
    if evidence:
        schema.add(evidence, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = index.value
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            keys = [xxhash.xxh3_128_digest(t or "") for t in texts]
            new = {k: t for k, t in zip(keys, texts) if k not in x.known}
            scores = dict(zip(new, x.score_all(list(new.values()))))
            found = [scores[k] if k in scores else x.known[k] for k in keys]
            if len(x.known) > REMEMBERED:
                x.known.clear()
            x.known |= scores
            columns = [pa.array([s for s, _ in found], pa.float64())]
            if evidence:
                flat = list(zip(*(x for _, e in found for x in e))) or [(), (), ()]
                at = pa.array(np.cumsum([0, *(len(e) for _, e in found)]).astype(np.int32))
                parts = [pa.array(c, k) for c, k in zip(flat, (pa.int64(), pa.float64(), pa.int32()))]
                columns.append(pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(parts, names=["doc_id", "cosine", "label"])))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *columns], names=schema.names)

    out = docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
    return out.select(
        *keep, F.coalesce(held_out(F.col(doc_id)), F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= REJECT).cast("int").alias("predicted"), *([evidence] if evidence else [])
    )
