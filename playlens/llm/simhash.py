"""SimHash near-duplicates: fingerprints, pigeonhole blocks, checked Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import LOWER, UPPER, any_names, checkpointed, task_count
from playlens.llm.components import connected_components

SEED = 42
_CHUNK = 1 << 16  # shingles hashed at once, so that a very long text needs no more memory
_LOWER = str.maketrans(UPPER, LOWER)
_SPACES = str.maketrans("\t\n\v\f\r", "     ")
#: Different fingerprints of one bucket that one task compares; larger buckets are cut into tiles of two such parts.
TILE = 4096


def fingerprint(text: str | None, width: int = 4) -> int:
    """A bit is 1 if it is set in over half of the XXH64 of the ``width``-word shingles, repeats included. Words part
    at ASCII white space, A-Z count as a-z. Fewer words: one shingle of all; none, or null: zero."""
    words = [w for w in (text or "").translate(_SPACES).split(" ") if w] if text else []
    if not words:
        return 0
    words = " ".join(words).translate(_LOWER).encode().split(b" ")
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        part = words[at : min(at + _CHUNK, n) + width - 1]
        if n == 1:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*(part[i:] for i in range(width))))
        hashes = np.array([h(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@any_names
def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in place of the text."""
    keep = [c for c in docs.columns if c not in (text, into)]
    schema = docs.select(*keep).schema.add(into, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array([fingerprint(t, width) for t in b.column(b.schema.get_field_index("__text")).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(f, pa.int64())], names=[*keep, into])

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def block_plan(n: int, bits: int) -> list[list[tuple[int, int]]]:
    """The tables for ``n`` different fingerprints: each a list of (shift, width) whose bits together are its key.

    64 bits are cut into ``b`` blocks; two fingerprints at most ``bits`` apart agree on at least ``b - bits`` of them, so
    they share the key of a table for some choice of ``b - bits`` blocks. Every ``b`` finds every pair. More blocks
    mean longer keys and smaller buckets, but more copies of each fingerprint; ``b`` is where both together cost least.
    """

    def cost(b: int) -> float:
        return comb(b, bits) * n * (40 + n / 2 ** (64 * (b - bits) // b))

    b = min(range(bits + 1, bits + 6), key=cost)
    edges = [64 * i // b for i in range(b + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in pick] for pick in combinations(range(b), b - bits)]


def _key(table: list[tuple[int, int]]) -> F.Column:
    out = F.lit(0).cast("long")
    for shift, width in table:
        part = F.shiftrightunsigned("f", shift).bitwiseAND((1 << width) - 1) if width < 64 else F.col("f")
        out = F.shiftleft(out, width).bitwiseOR(part)
    return out


def forest(values: np.ndarray, split: int, bits: int) -> list[tuple[int, int]]:
    """Links (i, j) within ``bits`` that connect what all such links of ``values`` connect: at most ``len - 1``.

    With ``split`` > 0 only links between the first ``split`` values and the rest, and within neither, are needed; more do no harm.
    A value that joins the tree of another is not compared with it again, so a dense group costs little more than its
    size times the number of its trees.
    """
    n = len(values)
    if n <= 256:  # the matrix of a small group, unless its links are many
        near = np.bitwise_count(values[:, None] ^ values) <= bits
        i, j = np.nonzero(np.triu(near, 1))
        if len(i) < n:
            return list(zip(i.tolist(), j.tolist()))
    root, out = np.arange(n), []
    for i in range(n):
        others = np.flatnonzero(root != root[i])
        if split and i < split:
            others = others[others >= split]
        elif split:
            break
        else:
            others = others[others > i]
        if not len(others):
            continue
        near = others[np.bitwise_count(values[others] ^ values[i]) <= bits]
        while len(near):
            j = near[0]
            out.append((i, int(j)))
            root[root == root[j]] = root[i]
            near = near[root[near] != root[i]]
    return out


def _links(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (t, k, tile): each run of equal ones is a bucket, or a tile of a large one."""
        key, side, held = None, [], []

        def done() -> list[tuple[int, int]]:
            f, s = np.concatenate(held), np.concatenate(side)
            if len(f) < 2:
                return []
            order = np.argsort(s, kind="stable")
            f, first = f[order], int((s == 0).sum())
            two = first if 0 < first < len(f) and s.max() == 1 else 0
            v = f.view(np.uint64)
            return [(int(f[i]), int(f[j])) for i, j in forest(v, two, bits)]

        def batch(links):
            a = np.array(links, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

        for b in batches:
            t, k, tile, s, f = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if not len(f):
                continue
            cut = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (tile[1:] != tile[:-1])) + 1
            links = []
            for lo, hi in zip([0, *cut], [*cut, len(f)]):
                own = (t[lo], k[lo], tile[lo])
                if own != key:
                    if held:
                        links += done()
                    key, side, held = own, [], []
                held.append(f[lo:hi]), side.append(s[lo:hi])
            if links:
                yield batch(links)
        if held and (links := done()):
            yield batch(links)

    return run


def close_links(distinct: DataFrame, bits: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): links between fingerprints ``f`` at most ``bits`` apart. Not all, but they connect whatever all connect.

    Each fingerprint goes to one bucket a table. Buckets are counted first (map-side combine); those of one are
    dropped. A bucket of up to ``tile`` fingerprints is compared in one task. A larger one is dealt into parts by hash,
    and each pair of parts is a task of its own, so no task holds over about ``2 * tile`` fingerprints of a bucket.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    tables = block_plan(max(n, 1), bits)
    rows = distinct.select("f", F.posexplode(F.array(*[_key(t) for t in tables])).alias("t", "k"))
    counts = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = rows.join(counts, ["t", "k"])
    parts = F.ceil(F.col("n") / tile).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64("f"), parts).cast("int")).otherwise(F.lit(0))
    # the tiles of part p: (p, q) for each q; in (p, q) with p < q, p is side 0 and q is side 1; (p, p) is compared with itself
    dealt = shared.select("t", "k", "f", part.alias("p"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("q")).select(
        "t", "k", (F.least("p", "q").cast("long") * (1 << 31) + F.greatest("p", "q")).alias("tile"), (F.col("p") > F.col("q")).cast("int").alias("s"), "f"
    )
    dealt = dealt.repartition(task_count(spark, n * len(tables) // 50, 200_000), "t", "k", "tile").sortWithinPartitions("t", "k", "tile")
    return dealt.select("t", "k", "tile", "s", "f").mapInArrow(_links(bits), "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, bits: int = 4, tile: int = TILE) -> DataFrame:
    """(doc_id, th, f, component_id) for each row of ``docs``: its id, the XXH64 of its text, its fingerprint as a signed
    long, and the smallest doc_id reachable by links between fingerprints at most ``bits`` apart.

    Equal fingerprints are one node, so a group of copies costs one row however large it is. Null and empty texts have
    fingerprint zero and are linked like any other. Repeated rows stay. A null doc_id names a component only if no
    other id does (then it is null). An empty table gives no rows.
    """
    t = F.col(text).cast("string")
    prints = checkpointed(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("th"), t.alias("t")), "t", width, "f"), "fingerprints")
    nodes = checkpointed(prints.groupBy("f").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(close_links(nodes.select("f"), bits, tile)).select(F.col("node").alias("f"), "root")
    linked = roots.join(nodes, "f").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(linked, "root").select("f", "component_id")
    ids = nodes.join(named, "f", "left").select("f", F.coalesce("component_id", "least").alias("component_id"))
    ids = checkpointed(ids, "components")  # a table of its own: the join may split a fingerprint with very many copies
    return prints.join(ids, "f").select("doc_id", "th", "f", "component_id")


@any_names
def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate component, the one with the smallest id. A document is an id
    and a text: rows that repeat both become one. Without any id in a component its documents all stay."""
    found = near_duplicates(docs, text, doc_id, width, bits)
    stay = found.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    stay = checkpointed(stay.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "n"), "stay")
    kept = docs.join(stay.drop("n"), F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__th")), "left_semi")
    return kept if stay.where("n > 1").isEmpty() else kept.dropDuplicates([doc_id, text])


def print_hex(f: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))
