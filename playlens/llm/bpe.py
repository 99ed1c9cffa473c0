"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import any_names

# Fixed value: the pattern that byte-level vocabularies of this kind part a text by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
#: Encoded pieces that a task remembers, and the longest piece that it remembers, in characters.
REMEMBERED, LONGEST = 200_000, 64


def byte_letters() -> list[str]:
    """The printable letter by which such a vocabulary file writes each byte: itself where it is printable, else the
    next free code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class Codec:
    """Exact encoding with a byte-level vocabulary file of the tokenizers library; special tokens in a text are taken
    as such, and none are added."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.letters = byte_letters()
        self.vocab: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in self.rank}
        self.fits: dict[tuple[str, str], bool] = {}
        self.right_edge = lru_cache(None)(lambda t: self._edge(t, 1))  # one entry a token at most
        self.left_edge = lru_cache(None)(lambda t: self._edge(t, 0))
        of = {c: b for b, c in enumerate(self.letters)}
        self.bytes = {i: bytes(of[c] for c in t) for t, i in self.vocab.items() if all(c in of for c in t)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split = regex.compile(SPLIT)
        self.letter_of = dict(enumerate(self.letters))
        # a token that isn't its own encoding never occurs
        self.whole = {t for t in self.vocab if t not in self.special and self._merged(list(t)) == [t]}
        self.id_bytes = {t: i.to_bytes(4, "little") for t, i in self.vocab.items()}
        self.automaton = ahocorasick.Automaton()
        for t in self.whole:
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _merged(self, parts: list[str]) -> list[str]:
        """Merges of one or two tokens' letters by rank: the definition, for short strings only."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The pieces at one end of a token while it is merged, first to last, each with the rank of the merge that takes it."""
        out, until = [], 1 << 60
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out[::-1]
            until = self.rank[self.parts[token]]
            token = self.parts[token][side]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the encoding of both in a row is just the two.

        Merges at either side of the border go up in rank, so it falls only if the pieces that meet there at some time
        have a merge of a lower rank than those that take them away; of equal ranks the one further left comes first.
        """
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= 2 * REMEMBERED:
                self.fits.clear()
            a, b, i, j, known, rank = self.right_edge(left), self.left_edge(right), 0, 0, True, self.rank
            while True:
                (x, x_until), (y, y_until) = a[i], b[j]
                r = rank.get((x, y))
                if r is not None and r < x_until and r <= y_until:
                    known = False
                    break
                if i + 1 == len(a) and j + 1 == len(b):
                    break
                if x_until <= y_until:
                    i += 1
                else:
                    j += 1
            self.fits[left, right] = known
        return known

    def piece(self, text: str) -> bytes:
        """The ids of one piece, as little-endian unsigned 32-bit integers.

        A row of tokens is an encoding exactly if each is compatible with the next. So each prefix has one last token:
        of the tokens that end there (all matches of the automaton), the one that is compatible with the last token of
        the prefix before it. The ids follow from the last prefix by the back-pointers.
        """
        letters = text.encode().decode("latin-1").translate(self.letter_of)
        if letters in self.whole:  # the last token of the last prefix
            return self.id_bytes[letters]
        last: list[str | None] = [None] * (len(letters) + 1)
        last[0], fits, compatible = "", self.fits, self.compatible
        for end, token in self.automaton.iter(letters):
            if last[end + 1] is None:
                before = last[end + 1 - len(token)]
                if before is not None and (not before or (fits[before, token] if (before, token) in fits else compatible(before, token))):
                    last[end + 1] = token
        out, at = [], len(letters)
        while at:
            out.append(self.id_bytes[last[at]])
            at -= len(last[at])
        return b"".join(reversed(out))

    def _plain(self, text: str) -> bytes:
        known, out = self.known, []
        for p in self.split.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.before.get(p) or self.piece(p)
                if len(p) <= LONGEST:
                    if len(known) >= REMEMBERED:  # frequent pieces come back from the older half
                        self.before, known = known, {}
                        self.known = known
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if self.at_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in self.at_special.split(text) if p)

    def forget(self) -> None:
        """What was remembered goes; the vocabulary stays."""
        self.known, self.before = {}, {}
        self.fits.clear()

    def decode(self, ids: bytes) -> str:
        """Bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    """One a Python worker."""
    return Codec(path)


@any_names
def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit integers), ``n_tokens`` and, unless None, the text that
    the ids decode to. Columns of these names are replaced. Whole texts; null counts as empty (no ids, empty text).

    One pass without a shuffle: rows are independent. ``vocabulary`` is a path that every executor has. Pieces are
    remembered up to a fixed number a task, so memory doesn't grow with the input.
    """
    new = [ids, "n_tokens", *([decoded] if decoded else [])]
    keep = [c for c in docs.columns if c not in new]
    schema = T.StructType([*docs.select(*keep).schema, T.StructField(ids, T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    if decoded:
        schema.add(decoded, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            encoded = [c.encode(t or "") for t in b.column(len(keep)).to_pylist()]
            columns = [pa.array(encoded, pa.binary()), pa.array([len(e) // 4 for e in encoded], pa.int64())]
            if decoded:
                columns.append(pa.array([c.decode(e) for e in encoded], pa.string()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *columns], names=[*keep, *schema.names[len(keep) :]])
        c.forget()  # the worker goes on to other stages

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
