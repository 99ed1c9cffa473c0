import hashlib
import random
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlens.llm import queries, windows
from tests.conftest import SMALL


def slow(rows, width=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    n = Counter(t[k : k + width] for _, t in data for k in range(len(t) - width + 1))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if n[t[k : k + width]] > 1:
                gone[k : k + width] = b"\x01" * width
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, kept))
    return sorted(out, key=str)


def run(frame, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in windows.remove_repeats(frame, **kw).collect()), key=str)


def mixed(rng, n=60, alphabet="abcdefé "):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 300))) for _ in range(12)]
    out = []
    for i in range(n):
        t = "".join(rng.choice(base) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(0, 6)))
        out.append((i, t))
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = sorted((i, a, b, c, hashlib.sha256(k).hexdigest()) for i, a, b, c, k in slow(rows))
    assert sorted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in queries.op7_repeats(spark, SMALL).collect()) == want
    assert any(r[2] for r in want)


def test_shared_passages_with_small_and_large_groups(docs):
    rows = mixed(random.Random(4))
    rows += [(100, rows[5][1]), (101, None), (102, ""), (5, rows[5][1]), (None, rows[7][1]), (103, "ab" * 400), (104, "a" * 700), (105, "x" + "a" * 100)]
    for kw in ({}, {"group": 1}, {"group": 3, "digit": 8}):
        assert run(docs(rows), **{"width": 40, "digit": 16} | kw) == slow(rows, 40)
    assert run(docs([])) == []


def test_documents_longer_than_a_part(docs, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh") for _ in range(1_300_000))
    rows = [(0, long), (1, "x" + long[900_000:1_200_000] + "y"), (2, long[1_048_500:1_049_100])]
    got = {r[0]: r for r in run(docs(rows))}
    assert got[0][1:4] == (1_300_000, 300_000, 1) and got[0][4] == (long[:900_000] + long[1_200_000:]).encode()
    assert got[1][1:] == (300_002, 300_000, 1, b"xy") and got[2][1:] == (600, 600, 1, b"")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab\U0001f600", max_size=40), max_size=6))
def test_any_mix(docs, texts):
    rows = list(enumerate(texts))
    assert run(docs(rows), width=6, digit=3) == slow(rows, 6)
