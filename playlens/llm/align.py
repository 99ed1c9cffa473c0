"""Alignment of two tokenizations of each text, and how surely each token of one answers to which of the other."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from playlens.llm.bpe import SPLIT, byte_letters
from playlens.llm.common import checkpointed

#: Bytes of text that are aligned at once. A longer text is cut where tokens of both sides end.
PART = 1 << 20
#: Pairs whose counts every task holds, the most frequent ones: 16 bytes each. Rarer pairs meet their counts in a join.
HEAD = 1 << 19
#: A pair of ids as one number: the A id in the upper half, the B id in the lower.
_B_BITS = 32


class Pair:
    """Two encoders: A, a byte-level vocabulary file of the tokenizers library, and B, a sentencepiece model."""

    def __init__(self, a_file: str, b_file: str):
        with open(a_file, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        of = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        # ids of such a file go up in the order of its merges, so they are the ranks; special tokens are left out: plain text
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b_file)
        a_bytes = {i: t for t, i in ranks.items()}
        self.a_size = np.array([len(a_bytes.get(i, b"")) for i in range(max(a_bytes) + 1)], np.int64)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        names = [str(i) for i in range(max(len(self.a_size), len(self.b_size)))]
        #: each id with what may follow it: a token of its side, the other side, the next group
        self.written = [n + mark for n in names for mark in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of both sides; None where a side's bytes aren't a space and the text."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for t, b in zip(texts, self.b.encode(texts, num_threads=1)):
            plain = f" {t}"
            a = self.a.encode_ordinary(plain)
            raw = plain.encode()
            fits = self.a.decode_bytes(a) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if fits else None)
        return out


@lru_cache(2)
def pair(a_file: str, b_file: str) -> Pair:
    """One a Python worker."""
    return Pair(a_file, b_file)


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that share bytes, as places in both sides, ordered. Starts go up through the documents.

    Each token's start lies in one token of the other side. Of two tokens that overlap the later start lies in the other
    token, so both directions together give all; tokens that start together are found twice and count once."""
    a = pd.DataFrame({"doc": a_doc, "start": a_start, "a": np.arange(len(a_start))})
    b = pd.DataFrame({"doc": b_doc, "start": b_start, "b": np.arange(len(b_start))})
    ahead = pd.merge_asof(a, b, on="start", by="doc")
    back = pd.merge_asof(b, a, on="start", by="doc")
    first, second = ahead["b"].to_numpy(), back["a"].to_numpy()
    late = b_start != a_start[second]  # else the other direction has it
    x, y = np.concatenate([a["a"].to_numpy(), second[late]]), np.concatenate([first, b["b"].to_numpy()[late]])
    order = np.argsort(x * (len(b) + 1) + y)
    return x[order], y[order]


def _grouped(p: Pair, part: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[str, np.ndarray, int, int]]:
    """Of each piece (document, A ids, B ids; none empty): its groups as text, its links as pairs of ids, groups, overlaps."""
    a, b = np.concatenate([x for _, x, _ in part]), np.concatenate([x for _, _, x in part])
    n_a, n_b = np.array([len(x) for _, x, _ in part]), np.array([len(x) for _, _, x in part])
    a_end, b_end = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
    a_doc, b_doc = np.repeat(np.arange(len(part)), n_a), np.repeat(np.arange(len(part)), n_b)
    x, y = overlaps(a_end - p.a_size[a], a_doc, b_end - p.b_size[b], b_doc)
    link = a_end[x] == b_end[y]
    doc = a_doc[x]
    n_overlaps = np.bincount(doc, minlength=len(part))
    x, y, doc = x[link], y[link], doc[link]  # the last tokens of each group
    a_group, b_group = np.searchsorted(x, np.arange(len(a))), np.searchsorted(y, np.arange(len(b)))
    a_in, b_in = np.diff(np.r_[-1, x]), np.diff(np.r_[-1, y])
    codes = np.zeros(len(a) + len(b), np.int64)
    a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_mark[x], b_mark[y] = 1, 2
    codes[np.arange(len(a)) + (np.cumsum(b_in) - b_in)[a_group]] = a * 3 + a_mark
    codes[np.arange(len(b)) + np.cumsum(a_in)[b_group]] = b * 3 + b_mark
    shown = list(map(p.written.__getitem__, codes.tolist()))
    ends, pairs = np.cumsum(n_a + n_b), (a[x] << _B_BITS) | b[y]
    groups = np.bincount(doc, minlength=len(part))
    cuts = np.cumsum(groups)
    return [
        ("".join(shown[e - n : e])[:-1], pairs[c - g : c], int(g), int(o))
        for e, n, c, g, o in zip(ends.tolist(), (n_a + n_b).tolist(), cuts.tolist(), groups.tolist(), n_overlaps.tolist())
    ]


def _pieces(p: Pair, doc: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A document in pieces of about PART bytes, cut where tokens of both sides end: no token and no group is parted."""
    a_end, b_end = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
    if not len(a_end) or a_end[-1] <= PART:
        yield doc, a, b
        return
    both = np.intersect1d(a_end, b_end)
    cut = np.unique(both[np.searchsorted(both, np.arange(PART, a_end[-1] + PART, PART).clip(max=both[-1]))])
    i = j = 0
    for k, m in zip(np.searchsorted(a_end, cut) + 1, np.searchsorted(b_end, cut) + 1):
        yield doc, a[i:k], b[j:m]
        i, j = k, m


def aligned(p: Pair, texts: list[str | None]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
    """(n_a, n_b, n_groups, n_overlaps, groups, links as pairs) of each text."""
    out: list[tuple[int, int, int, int, str, np.ndarray]] = [(0, 0, 0, 0, "", np.zeros(0, np.int64))] * len(texts)
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    found: dict[int, list] = {}
    size = 0

    def done() -> None:
        for (doc, a, b), parts in zip(held, _grouped(p, held)):
            found.setdefault(doc, []).append((len(a), len(b), *parts))
        held.clear()

    some = [i for i, t in enumerate(texts) if t]
    while some:
        now, n = [], 0
        while some and (not now or n + len(texts[some[0]]) <= PART):
            n += len(texts[some[0]])
            now.append(some.pop(0))
        for i, ids in zip(now, p.encode([texts[i] for i in now])):
            for piece in _pieces(p, i, *ids) if ids else ():
                held.append(piece)
                size += int(p.a_size[piece[1]].sum())
                if size >= PART:
                    done()
                    size = 0
    if held:
        done()
    for i, parts in found.items():
        n_a, n_b, text, pairs, groups, shared = zip(*parts)
        out[i] = (sum(n_a), sum(n_b), sum(groups), sum(shared), ";".join(text), np.concatenate(pairs))
    return out


NEW = ("n_a", "n_b", "n_groups", "n_overlaps", "groups", "pairs", "times")


def align(docs: DataFrame, a_file: str, b_file: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, and with (columns of these names are replaced):

    * ``n_a``, ``n_b``: tokens of A for a space and the text, of B for the text; special tokens' strings are plain text
    * ``n_overlaps``: pairs of an A and a B token that share bytes
    * ``n_groups``, ``groups``: the shortest runs of tokens that span the same bytes on both sides, as
      ``a1,a2|b1;a3|b2,b3`` (ids; a group ends where tokens of both sides end)
    * ``pairs``, ``times``: the links, that is the A and B tokens that end together, as ``a << 32 | b``, each with its number

    Null and empty texts, and those whose tokens of a side don't join to a space and the text (a literal U+2581, for one),
    have no tokens: zeros, an empty string, empty arrays. Repeated rows are aligned alike.

    Rows are independent: one pass, no shuffle. Both files must be on every executor. About PART bytes of text are
    aligned at once; a longer text is cut where tokens of both sides end, which changes nothing.
    """
    keep = [c for c in docs.columns if c not in (text, *NEW)]
    schema = T.StructType([*docs.select(*keep).schema])
    for name in NEW[:4]:
        schema.add(name, "long")
    schema.add("groups", "string").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(a_file, b_file)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            lo = 0
            while lo < len(texts):  # answers are longer than texts: in steps
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= 4 * PART):
                    size += len(texts[hi] or "")
                    hi += 1
                found = aligned(p, texts[lo:hi])
                counted = [np.unique(f[5], return_counts=True) for f in found]
                at = pa.array(np.cumsum([0, *(len(u) for u, _ in counted)]).astype(np.int32))
                numbers = [pa.array([f[k] for f in found], pa.int64()) for k in range(4)]
                lists = [
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate([c[k] for c in counted]).astype(kind)))
                    for k, kind in enumerate((np.int64, np.int32))
                ]
                own = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, *numbers, pa.array([f[4] for f in found], pa.string()), *lists], names=schema.names)
                lo = hi

    return docs.select(*keep, F.col(text).cast("string").alias("t")).mapInArrow(run, schema)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of each batch of (pairs, times)."""
    for b in batches:
        flat = [b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1)]
        u, at = np.unique(flat[0], return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(at, flat[1], len(u)).astype(np.int64))], names=["pair", "n"])


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold each pair, and whether no pair with its B id has more."""
    own = rows.select("pairs", "times").mapInArrow(_summed, "pair long, n long")
    counts = checkpointed(own.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return checkpointed(counts.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _looked_up(shared):
    """The sums over the links whose pair is in the head, and the other links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for b in batches:
            own, times = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
            sizes = np.diff(b.column(1).offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(pairs, own).clip(max=max(len(pairs) - 1, 0))
            known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            hit = at[known]
            sums = np.zeros((2, len(sizes)), np.int64)
            np.add.at(sums[0], row[known], times[known] * best[hit])
            np.add.at(sums[1], row[known], times[known] * n[hit])
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row[~known], minlength=len(sizes)))].astype(np.int32))
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~known])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, sums), *rest], names=["u", "n_best", "count_sum", "pairs", "times"])

    return run


def judge_links(rows: DataFrame, head: int = HEAD) -> DataFrame:
    """``rows`` of ``align`` (``groups`` may be left out) without ``pairs`` and ``times``, and with ``n_links``, ``n_best`` (links whose
    pair is the most frequent one of its B id in the whole corpus, ties included) and ``count_sum`` (the sum of the links' corpus counts).

    A row without links has zeros; repeated rows count each time, and no rows give no rows. Pairs are counted batch by
    batch before their shuffle. The counts of the ``head`` most frequent pairs at most go to every task; links of rarer
    pairs meet theirs in a join, so no link waits on a bound. All rows and counts are written to the shared folder.
    """
    spark = rows.sparkSession
    keep = [c for c in rows.columns if c not in ("pairs", "times", "n_links", "n_best", "count_sum")]
    whole = F.struct(*keep).alias("row")
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("u"), whole, "pairs", "times"), "aligned")
    counts = pair_counts(rows)
    sizes = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).orderBy(F.desc("k"))
    least, room = None, head
    for r in sizes.collect():  # a row for each quarter of a power of two
        room -= r["m"]
        if room < 0:
            break
        least = r["least"]
    frequent = counts.where(F.col("n") >= least) if least is not None else counts.limit(0)
    table = frequent.toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast((table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy().astype(np.int64)))
    kinds = "u long, n_best long, count_sum long, pairs array<long>, times array<int>"
    first = checkpointed(rows.select("u", "pairs", "times").mapInArrow(_looked_up(shared), kinds), "links")
    rest = first.select("u", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("u", "x.pairs", "x.times")
    rest = rest.join(counts, F.col("pairs") == F.col("pair")).select("u", (F.col("best").cast("long") * F.col("times")).alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
    sums = first.select("u", "n_best", "count_sum").unionAll(rest).groupBy("u").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    links = F.coalesce(F.aggregate("times", F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).alias("n_links")
    return rows.select("u", "row", links).join(sums, "u").select("row.*", "n_links", "n_best", "count_sum")
