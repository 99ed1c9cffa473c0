"""Personal data: patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.llm.common import any_names, checkpointed

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive where that finds the same and keeps the time linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, those that fail their check left out; in order of start, then kind."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1) if start < at else end
        at = text.find("@", max(at + 1, end if m else 0))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(n := p.lstrip("0")) < 4 and int(n or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if 12 <= len(m[0]) < 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---- the model ----

#: Characters of a passage's entity that is trained on, at most. A written-out at-sign or dot is one atom, so in any of its variants it
#: has at most as many atoms, and a candidate may have them all; the dynamic program is linear in the text for it.
LONGEST = 60
_ATOM = re.compile(r"\x20?[\[(]\x20?(?:at|dot)\x20?[\])]\x20?|[A-Za-z]+|[0-9]+|\s+|.", re.S | re.I)
_AT = re.compile(r"[\x20]?[\[(]\x20?at\x20?[\])][\x20]?", re.I)
_DOT = re.compile(r"[\x20]?[\[(]\x20?dot\x20?[\])][\x20]?", re.I)
_TRIGGER = re.compile(r"[0-9]|@|[\[(]\x20?at\x20?[\])]", re.I)
_REACH = re.compile(r"[0-9]|@|[\[(]\x20?(?:at|dot)\x20?[\])]", re.I)
_MARK = re.compile(r"\x20?[\[(]\x20?(?:at|dot)\x20?[\])]\x20?", re.I)
_SAID = (frozenset("mail email mailto contact write".split()), frozenset("ip host server address".split()), frozenset("card visa credit debit account".split()), frozenset("phone tel telephone call fax mobile cell".split()))
FEATURES = 30


def features(span: str, left: str, right: str, word: str) -> np.ndarray:
    """What a whole candidate is like: ``left`` and ``right`` are the characters beside it, ``word`` the one before it."""
    x = np.zeros(FEATURES)
    d = _digits(span)
    plain = _DOT.sub(".", _AT.sub("@", span))
    groups = re.findall(r"[0-9]+", span)
    x[0] = 1
    x[1] = plain.count("@") == 1
    x[2] = bool(_AT.search(span))
    x[3] = bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", plain))
    x[4] = plain.count("@") > 1
    x[5] = bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", span)) and all(int(g) <= 255 for g in groups)
    x[6] = "." in span and len(groups) in (2, 3) and not x[1]
    x[7] = bool(re.fullmatch(r"[0-9](?:[ -]?[0-9])*+", span))
    x[8] = bool(x[7]) and 12 <= len(d) <= 19 and luhn(d)
    x[9] = bool(x[7]) and 12 <= len(d) <= 19 and not x[8]
    x[10] = span[0] == "+"
    x[11] = 9 <= len(d) <= 15
    x[12] = bool(re.search(r"\([0-9]{2,4}\)", span))
    x[13] = bool(re.search(r"(?<![0-9])[0-9]{3}[ .-][0-9]{4}$", span))
    x[14] = 7 <= len(d) <= 8
    letters = any(c.isalpha() for c in span)
    x[15] = letters and not x[1]
    x[16] = bool(re.search(r"[A-Za-z][0-9]|[0-9][A-Za-z]", span)) and not x[1]
    x[17] = left.isalnum() or left in "._%+-@" and bool(left)
    x[18] = right.isalnum() or right in "@_+" and bool(right)
    x[19] = bool(re.fullmatch(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}", span))
    x[20] = len(groups) == 1
    for i, said in enumerate(_SAID):
        x[21 + i] = word in said
    x[25] = len(d) < 7
    x[26] = span.count("(") != span.count(")") or span.count("[") != span.count("]")
    x[27] = len(groups) > 5
    x[28] = bool(x[12] and x[13] and 10 <= len(d) <= 12)
    return x


class Part:
    """A stretch of text and its candidates, as places between atoms."""

    def __init__(self, text: str, lo: int, hi: int):
        self.cuts = [lo, *(m.end() for m in _ATOM.finditer(text, lo, hi))]
        self.spans: list[tuple[int, int]] = []
        rows = []
        mark = [bool(_MARK.fullmatch(text, a, b)) for a, b in zip(self.cuts, self.cuts[1:])] + [False]
        starts = [text[c] if c < hi else "" for c in self.cuts]
        for i in range(len(self.cuts) - 1):
            if not (starts[i].isalnum() or starts[i] in "+("):
                continue
            word = re.search(r"([A-Za-z]+)[^A-Za-z0-9]{0,3}$", text[max(0, self.cuts[i] - 24) : self.cuts[i]])
            for j in range(i + 1, min(len(self.cuts), i + 1 + LONGEST)):
                s = text[self.cuts[i] : self.cuts[j]]
                if "\n" in s:
                    break
                if s[-1].isalnum() and len(s) >= 4 and _TRIGGER.search(s):
                    self.spans.append((i, j))
                    rows.append(features(s, text[self.cuts[i] - 1 : self.cuts[i]], text[self.cuts[j] : self.cuts[j] + 1], word[1].lower() if word else ""))
                    rows[-1][29] = mark[j] or i > 0 and mark[i - 1]  # a written-out address goes on beside it
        self.x = np.array(rows).reshape(-1, FEATURES)
        order = sorted(range(len(self.spans)), key=lambda k: self.spans[k][1])
        self.by_end: dict[int, list[int]] = {}
        for k in order:
            self.by_end.setdefault(self.spans[k][1], []).append(k)

    def best(self, w: np.ndarray) -> list[Span]:
        """Boundaries and kinds of the best segmentation. Atoms outside of entities are segments of their own and score zero."""
        n = len(self.cuts) - 1
        s = self.x @ w
        top, kind = (s.max(1), s.argmax(1)) if len(s) else (s, s)
        score, back = np.zeros(n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            score[j] = score[j - 1]
            for k in self.by_end.get(j, ()):
                v = score[self.spans[k][0]] + top[k]
                if v > score[j]:
                    score[j], back[j] = v, k
        out, j = [], n
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                i, _ = self.spans[back[j]]
                out.append((KINDS[kind[back[j]]], self.cuts[i], self.cuts[j]))
                j = i
        return out[::-1]

    def slope(self, w: np.ndarray, gold: dict[tuple[int, int], int]) -> tuple[float, np.ndarray]:
        """The log-likelihood of the segmentation ``gold`` ({places: kind number}) and its gradient, by forward and backward sums."""
        n = len(self.cuts) - 1
        s = self.x @ w
        each = np.logaddexp.reduce(s, axis=1) if len(s) else np.zeros(0)
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            ks = self.by_end.get(j, ())
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[self.spans[k][0]] + each[k] for k in ks)])
        by_start: dict[int, list[int]] = {}
        for k, (i, _) in enumerate(self.spans):
            by_start.setdefault(i, []).append(k)
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[self.spans[k][1]] + each[k] for k in by_start.get(i, ()))])
        if not len(s):
            return 0.0, np.zeros_like(w)
        i, j = np.array(self.spans).T
        chance = np.exp((ahead[i] + behind[j] - ahead[n])[:, None] + s)
        true = np.zeros_like(chance)
        for k, span in enumerate(self.spans):
            if span in gold:
                true[k, gold[span]] = 1
        return float((true * s).sum() - ahead[n]), self.x.T @ (true - chance)


def _variants(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The text as it is, and with its entities written in ways that the base patterns miss."""
    yield text, spans
    for way in range(2):
        out, at, found = [], 0, []
        for kind, s, e in spans:
            if s < at:
                continue
            out.append(text[at:s])
            own = text[s:e]
            if kind == "phone":
                own = re.sub(r"^\+[0-9]{1,3}[ .-]?(?=\()", "", own) if way else own.lstrip("+")
            elif kind == "email":
                own = re.sub(r"\.", " [dot] ", own.replace("@", " [at] ")) if way else re.sub(r"\.(?=[^.]*$)", "(dot)", own.replace("@", "(at)"))
            lo = sum(map(len, out))
            out.append(own)
            found.append((kind, lo, lo + len(own)))
            at = e
        out.append(text[at:])
        yield "".join(out), found


def _decoys(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The text with each entity made into what looks like one and is none: a card's number that fails its check, in one run or in groups, an
    address part above 255, a run of digits, a path."""
    for way in range(2):
        out, at = [], 0
        for kind, s, e in spans:
            if s < at:
                continue
            own = text[s:e]
            d = _digits(own)
            if kind == "card":
                d = d[:-1] + str((int(d[-1]) + 1 + way) % 10)
                own = re.sub("[0-9]", lambda _, it=iter(d): next(it), own) if way else d
            elif kind == "ip":
                own = re.sub(r"^[0-9]+", lambda m: str(int(m[0]) + 300), own) if way else own.rpartition(".")[0]
            elif kind == "phone":
                own = d if way else f"{d[:4]}-{d[4:6]}-{d[6:8]}"
            else:
                own = own.replace("@", "/" if way else " 2 ")
            out += [text[at:s], own]
            at = e
        yield "".join([*out, text[at:]]), []


# Numbers that are no personal data, for the model to leave alone.
_NOT = ("on 2024-01-05 at 12:30", "version 3.0 of 1.2.3", "in 1998 and 2005", "a price of 12,500.00 now", "token 9f86d081884c7d65 end", "pages 100-250", "licence CC BY 4.0", "number 4663219866878", "id 100200300400500601", "about 3.14159 and 1.5", "05/11/2021", "10.1000/182", "1 2 3 4 5 6 7 8", "section 12.4.1.7.2")


def train(islands: list[tuple[str, list[Span]]], rounds: int = 40, penalty: float = 0.02) -> np.ndarray:
    """Weights (features by kinds) by likelihood, from texts with their base spans, ways to write them otherwise, and what looks like them and is none."""
    data = [(t, s) for text, spans in islands for t, s in [*_variants(text, spans), *_decoys(text, spans)]] + [(f"{a} {n} {b}", []) for n in _NOT for a, b in (("the", "of"), ("und", "."))]
    parts = []
    for text, spans in data:
        p = Part(text, 0, len(text))
        place = {c: i for i, c in enumerate(p.cuts)}
        gold = {(place[s], place[e]): KINDS.index(k) for k, s, e in spans if s in place and e in place}
        if len(gold) == len(spans) and set(gold) <= set(p.spans):
            parts.append((p, gold))
    w = np.zeros((FEATURES, len(KINDS)))
    w[0] = -2
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        g = -penalty * w
        for p, gold in parts:
            g += p.slope(w, gold)[1] / max(len(parts), 1)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return w


#: Characters of a stretch before its first digit or at-sign and after its last digit, at-sign or written-out dot: the longest label of a domain fits.
_BEFORE, _NEAR = 160, 72


def stretches(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """The parts of lines near a digit or an at-sign that no base span holds, cut at the base spans. Elsewhere there are no candidates."""
    spans = sorted((s, e) for _, s, e in taken)
    at, k, last = 0, 0, -1
    while m := _TRIGGER.search(text, at):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if k < len(spans) and spans[k][0] <= m.start():
            at = spans[k][1]
            continue
        lo = max(m.start() - _BEFORE, last, spans[k - 1][1] if k else 0, text.rfind("\n", 0, m.start()) + 1)
        stop = spans[k][0] if k < len(spans) else len(text)
        hi, end = m.end(), m.end()
        while (n := _REACH.search(text, hi, min(hi + _NEAR, stop))) and "\n" not in text[hi : n.start()]:
            hi = n.end()
        line = text.find("\n", hi, min(hi + _NEAR, stop))
        end = line if line >= 0 else min(hi + _NEAR, stop)
        yield lo, end
        at = last = max(end, m.end())


#: Characters of a stretch whose candidates are held at once.
_PIECE = 4000


def decoded(text: str, lo: int, hi: int, w: np.ndarray) -> list[Span]:
    """The best segmentation of the stretch. A long one is decoded in pieces, where the last candidates of a piece may reach into the next:
    scores are carried over each cut, so the result is that of the whole stretch."""
    if hi - lo <= _PIECE:
        return Part(text, lo, hi).best(w)
    cuts = [lo, *(m.end() for m in _ATOM.finditer(text, lo, hi))]
    score, back = np.zeros(len(cuts)), [None] * len(cuts)
    ends: dict[int, list[tuple[int, float, int]]] = {}
    first = last = 0
    for j in range(1, len(cuts)):
        if j > last:  # candidates that start in the next piece
            first = last
            while last < len(cuts) - 1 and (last == first or cuts[last] - cuts[first] < _PIECE):
                last += 1
            part = Part(text, cuts[first], cuts[min(len(cuts) - 1, last + LONGEST)])
            s = part.x @ w
            for (a, b), top, kind in zip(part.spans, s.max(1) if len(s) else s, s.argmax(1) if len(s) else s):
                if first + a < last:
                    ends.setdefault(first + b, []).append((first + a, top, kind))
        score[j] = score[j - 1]
        for i, top, kind in ends.pop(j, ()):
            if score[i] + top > score[j]:
                score[j], back[j] = score[i] + top, (i, kind)
    out, j = [], len(cuts) - 1
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            i, kind = back[j]
            out.append((KINDS[kind], cuts[i], cuts[j]))
            j = i
    return out[::-1]


def all_spans(text: str, w: np.ndarray | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans)"""
    base = base_spans(text)
    if w is None:
        return base, base
    more = []
    for lo, hi in stretches(text, base):
        more += decoded(text, lo, hi, w)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _islands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            spans = base_spans(t) if t else []
            for kind in KINDS:
                for _, s, e in [x for x in spans if x[0] == kind and x[2] - x[1] < LONGEST][:1]:
                    out.append((i, kind, t[max(0, s - 30) : e + 30]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["id", "kind", "t"])


#: Passages with a base span that the model is trained on, for each kind.
SAMPLE = 25


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """The model, from at most ``sample`` passages of each kind, those with the smallest hashes; None without any."""
    t = F.col(text).cast("string")
    found = docs.where(t.rlike("[0-9@]")).select(F.xxhash64(t).alias("id"), t.alias("t")).mapInArrow(_islands, "id long, kind string, t string")
    found = checkpointed(found.distinct(), "passages")
    rows = sum((found.where(F.col("kind") == k).orderBy("id", "t").limit(sample).collect() for k in KINDS), [])
    return train([(r["t"], base_spans(r["t"])) for r in rows]) if rows else None


@any_names
def find(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) in code points, the end exclusive, by start, then kind.

    ``base``: leftmost non-overlapping matches of each kind's pattern that pass its check (parts of an ip at most 255, Luhn, numbers of
    digits). ``spans``: those, and what the semi-Markov model adds in the text that no base span holds: it scores whole candidates
    (digits, checks, shape, neighbours) and picks boundaries and kinds together by dynamic programming over segments of at
    most ``LONGEST`` atoms. It is trained here on passages with base spans, on other ways to write them, and on decoys: the same passages with failing checks, digits, paths.
    Null counts as empty: no spans. Repeated rows are alike. Columns of these names are replaced. No text is shuffled.
    """
    w = fit(docs, text, sample)
    keep = [c for c in docs.columns if c not in ("base", "spans")]
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = docs.select(*keep).schema.add("base", span).add("spans", span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [all_spans(t, w) if t else ([], []) for t in b.column(len(keep)).to_pylist()]
            two = [pa.array([[dict(zip(("kind", "start", "end"), x)) for x in f[i]] for f in found], arrow) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *two], names=schema.names)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
