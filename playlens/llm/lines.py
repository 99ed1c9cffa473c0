"""Line dedup: two Bloom filters find the lines that may repeat; only those are shuffled and confirmed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.common import any_names, checkpointed

_SPACE = " \t\n\v\f\r"
#: A segment of a filter has 2**SEGMENT_BITS bits. A filter has at most 2**FILTER_BITS: 128 MB, the most that is broadcast.
#: Beyond about 10**8 lines the filters fill up; then more lines are shuffled, and the results stay the same.
SEGMENT_BITS, FILTER_BITS, BITS_A_LINE, LINE_BYTES, PROBES = 19, 30, 12, 100, 4
_FLUSH = 1 << 20


def line_key(line: str) -> bytes:
    """Stripped of ASCII white space at both ends, A-Z lower-cased, in UTF-8."""
    return line.strip(_SPACE).encode().lower()


def keys_of(text: str | None, least: int) -> list[tuple[int, bytes]]:
    """(line number, key) of the lines whose key has at least ``least`` code points."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        if len(line) >= least:
            key = line.strip(_SPACE)
            if len(key) >= least:
                out.append((i, key.encode().lower()))
    return out


def _spots(h: np.ndarray, segments: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash, and its PROBES bits in that segment."""
    seg = (h >> np.uint64(40)) & np.uint64(segments - 1)
    a, b = h & np.uint64((1 << width) - 1), (h >> np.uint64(width)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return seg.astype(np.int64), ((a[:, None] + steps * b[:, None]) & np.uint64((1 << width) - 1)).astype(np.int64)


def _hashes(least: int, segments: int):
    """One row for each segment and some million lines: the hashes of each document's different keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: list[int]):
            h = np.array(held, np.uint64)
            seg, _ = _spots(h, segments, SEGMENT_BITS)
            order = np.argsort(seg, kind="stable")
            h, seg = h[order], seg[order]
            cut = np.flatnonzero(np.diff(seg)) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(seg[np.r_[0, cut]], pa.int64()), pa.array([x.tobytes() for x in np.split(h, cut)], pa.binary())], names=["seg", "h"]
            )

        held: list[int] = []
        for b in batches:
            for t in b.column(0).to_pylist():
                held += {xxhash.xxh3_64_intdigest(k) for _, k in keys_of(t, least)}
                if len(held) >= _FLUSH:
                    yield rows(held)
                    held = []
        if held:
            yield rows(held)

    return run


def _twice(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The twice-seen filter of each segment. A hash whose bits are all set in the once-seen filter has its bits set in
        the twice-seen one. Rows come sorted by segment."""
        now, once, twice = None, None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["seg", "bits"])

        for b in batches:
            for seg, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if seg != now:
                    if now is not None and twice.any():
                        yield out()
                    now, once, twice = seg, np.zeros(1 << width, bool), np.zeros(1 << width, bool)
                # equal hashes of one row: all but the first meet themselves
                u, n = np.unique(np.frombuffer(h, np.uint64), return_counts=True)
                _, at = _spots(u, 1, width)
                twice[at[(n > 1) | once[at].all(1)].ravel()] = True
                # hashes of this row that meet only through each other's bits would need no mark: each key is one hash
                once[at.ravel()] = True
        if now is not None and twice.any():
            yield out()

    return run


def repeat_filter(docs: DataFrame, text: str, least: int, width: int = SEGMENT_BITS, filter_bits: int = FILTER_BITS) -> tuple[np.ndarray, int]:
    """The twice-seen filter over all lines as packed bits, and its number of segments. It has every key that two
    documents hold, and some others. At most 2**filter_bits bits, whatever the input."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    want = max(1, int(size) // LINE_BYTES * BITS_A_LINE >> width)
    segments = min(1 << (want - 1).bit_length(), 1 << (filter_bits - width))
    hashes = docs.select(F.col(text).cast("string")).mapInArrow(_hashes(least, segments), "seg long, h binary")
    dealt = hashes.repartition("seg").sortWithinPartitions("seg")
    full = np.zeros((segments, 1 << width >> 3), np.uint8)
    for row in dealt.mapInArrow(_twice(width), "seg long, bits binary").collect():
        full[row["seg"]] = np.frombuffer(row["bits"], np.uint8)
    return full.reshape(-1), segments


def _suspects(least: int, segments: int, width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            rows, lines, keys, hashes = [], [], [], []
            for r, t in enumerate(b.column(1).to_pylist()):
                for i, k in keys_of(t, least):
                    rows.append(r), lines.append(i), keys.append(k), hashes.append(xxhash.xxh3_64_intdigest(k))
            if not rows:
                continue
            seg, at = _spots(np.array(hashes, np.uint64), segments, width)
            spot = (seg[:, None] << width) + at
            hit = np.flatnonzero(((bits[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1).all(1))
            if not len(hit):
                continue
            found: dict[tuple[int, bytes], list[int]] = {}
            for x in hit:
                found.setdefault((rows[x], hashlib.blake2b(keys[x], digest_size=16).digest()), []).append(lines[x])
            at_rows = pa.array([r for r, _ in found])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at_rows), b.column(2).take(at_rows), pa.array([k for _, k in found], pa.binary()), pa.array(list(found.values()), pa.list_(pa.int32()))],
                names=["id", "th", "k", "at"],
            )

    return run


@any_names
def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = 20, least_docs: int = 3, segment_bits: int = SEGMENT_BITS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without the lines that other documents keep, and with ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. All lines whose key has at least
    ``least_chars`` code points and is in at least ``least_docs`` documents go, but for those in the document with the
    largest id among them. Other lines stay as they are, joined by newlines. A null or empty text is one empty line, and
    becomes empty. Each row is a document; rows with the largest id all keep the line. A null id is below all others.

    Pass 1 hashes each document's keys into two Bloom filters, in segments dealt over the tasks. Pass 2 probes the
    twice-seen one: only the suspected repeats are shuffled, as a 128-bit digest, the id and the line numbers, and
    counted exactly. A key that a third of all documents hold is summed up before its shuffle; the join that
    follows splits it. Documents then meet the line numbers they lose, at most one row a document.
    """
    spark: SparkSession = docs.sparkSession
    bits, segments = repeat_filter(docs, text, least_chars, segment_bits, filter_bits)
    shared = spark.sparkContext.broadcast(bits)
    t = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), t.alias("t"), F.xxhash64(t).alias("th")).mapInArrow(
        _suspects(least_chars, segments, segment_bits, shared), "id long, th long, k binary, at array<int>"
    )
    rows = checkpointed(rows, "suspects")
    bad = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).where(F.col("n") >= least_docs).select("k", "last")
    bad = checkpointed(bad, "repeats")  # read as a table of its own, its join may split a hot key
    lost = rows.join(bad, "k").where(~F.col("id").eqNullSafe(F.col("last")))
    # repeated rows lose the same lines: the set is the same
    lost = lost.groupBy("id", "th").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("__lost")).select(F.col("id").alias("__id"), F.col("th").alias("__th"), "__lost")
    keep = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    own = docs.select(*keep, t.alias(text), F.xxhash64(t).alias("__own"))
    joined = own.join(lost, (F.col("__own") == F.col("__th")) & F.col(doc_id).cast("long").eqNullSafe(F.col("__id")), "left")
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    schema = joined.select(*keep, text).schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.select(*keep, text, "__lost").mapInArrow(_cut(len(keep)), schema).select(*order, "n_lines", "n_dropped")


def _cut(at: int):
    """The column ``at`` holds the text, the one after it the numbers of its lost lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for t, lost in zip(b.column(at).to_pylist(), b.column(at + 1).to_pylist()):
                lines = (t or "").split("\n")
                gone = set(lost or ())
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t or "")
                n_lines.append(len(lines)), n_dropped.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(at)), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*b.schema.names[: at + 1], "n_lines", "n_dropped"],
            )

    return run
