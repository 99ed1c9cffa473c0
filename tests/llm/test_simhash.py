import random
import re

import numpy as np
import xxhash

from playlens.llm import queries, simhash
from tests.conftest import SMALL


def slow_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64(" ".join(words[i : i + width]).encode(), 42).intdigest() for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, bits=4):
    """{row number: smallest id} by comparing all."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = [(d, slow_print(t)) for d, t in texts.items()]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(rows, slow_components(rows))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SMALL).collect()}
    assert got == want


def test_null_empty_short_long_and_repeated_rows(spark, docs):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    texts = [None, "", " \t\n", "One", "one two\vthree", "a b c d", "A B C D", long, long + " end", "é É", "\x00 b"]
    frame = docs(texts).unionAll(docs([(5, "a b c d"), (None, "a b c d"), (None, "solo null id words here")]))
    got = [(r.doc_id, r.f % 2**64, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    rows = [(r.doc_id, slow_print(r.text)) for r in frame.collect()]
    want = [(d, f, c) for (d, f), c in zip(rows, slow_components(rows))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_rows(spark, docs):
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.keep_one(docs([])).count() == 0


def test_every_plan_finds_every_close_pair():
    rng = random.Random(1)
    for n in (10, 10**6, 10**9, 10**12):
        tables = simhash.block_plan(n, 4)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << i for i in rng.sample(range(64), 4))
            assert any(all((a >> s ^ b >> s) & ((1 << w) - 1) == 0 for s, w in t) for t in tables)


def test_large_buckets_are_tiled_without_loss(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(63)
    values = {centre ^ sum(1 << i for i in rng.sample(range(63), rng.randint(0, 7))) for _ in range(400)}
    values |= {rng.getrandbits(63) for _ in range(300)}
    frame = spark.createDataFrame([(v,) for v in values], "f long")
    from playlens.llm.components import connected_components

    want = slow_components([(v, v) for v in sorted(values)])
    for tile in (16, 4096):
        got = {r.node: r.root for r in connected_components(simhash.close_links(frame, 4, tile)).collect()}
        assert [got.get(v, v) for v in sorted(values)] == want


def test_forest_connects_with_fewer_links_than_values():
    dense = np.unique(np.random.default_rng(0).integers(0, 2**10, 600).astype(np.uint64))
    links = simhash.forest(dense, 0, 4)
    assert len(links) == len(dense) - 1


def test_keep_one(spark, docs):
    frame = docs(["x y z w v", "X y z w v", "other words that stand alone", None, ""])
    assert sorted(r.doc_id for r in simhash.keep_one(frame.unionAll(frame)).collect()) == [0, 2, 3]
    assert simhash.keep_one(frame).columns == frame.columns
