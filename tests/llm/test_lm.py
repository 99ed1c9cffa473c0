import math
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from playlens.llm import lm, queries
from playlens.llm.common import documents
from tests.conftest import SMALL


def out_of_sample(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def words(text):
    return [*(text or "").encode().translate(lm._LOWER).split(), None]


def base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)"""
    c = Counter(w for i, t in rows if not out_of_sample(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(i, out_of_sample(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 5)) for i, t in rows]


def got(frame, **kw):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in lm.score(frame, **kw).collect()), key=str)


ROWS = [
    (0, None), (1, ""), (2, "A b a"), (3, "a\tB\x0bc\x1cd\xa0e\x85f"), (4, "the " * 3000), (5, "日本語 x"), (None, "null id here"), (2, "A b a"), (16, "held"), (4, "\x00 \x00"),
    *[(i, f"word{i} the a word{i % 3}") for i in range(20, 60)], (9, "x" * 100_000),
]


@pytest.mark.parametrize("more", [{}, {"shard": 50, "bin_words": 5}])
def test_base_by_hand(docs, more):
    assert any(out_of_sample(i) for i, _ in ROWS)
    assert got(docs(ROWS), **more) == sorted(base(ROWS), key=str)


def test_query_by_hand(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    out = queries.op13_lm(spark, SMALL).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == sorted(base(rows))
    held = [r for r in out if r.held_out]
    size = {i: len((t or "").encode()) + 1 for i, t in rows}
    per_byte = -sum(r.score for r in held) / math.log10(2) / sum(size[r.doc_id] for r in held)
    assert per_byte < 3.3  # 200 documents to learn from; a byte drawn evenly takes 8 bits, one by its frequency over 4
    assert all(abs(r.bits_per_byte + r.score / math.log10(2) / size[r.doc_id]) < 1e-9 for r in out)


@pytest.fixture(scope="module")
def model(spark):
    return lm.train(documents(spark, SMALL))


def test_probabilities_add_up(model):
    """Those of all that may follow: the bytes, or the end."""
    for lead in (b"", b"the", "naïve é".encode(), b"\x00\x00 q"):
        key = int.from_bytes((bytes(5) + lead)[-5:], "big") << 8
        p = 2.0 ** -model.bits_of(np.arange(key, key + 256, dtype=np.uint64))
        assert abs(p.sum() - 1) < 1e-9


def test_a_score_is_the_sum_of_its_bytes_and_depends_on_the_text_alone(model):
    text = "A text of some words, é.".encode()
    raw = bytes(5) + text + lm.END
    one = sum(model.bits_of(np.array([int.from_bytes(raw[i : i + 6], "big")], np.uint64))[0] for i in range(len(text) + 1))
    alone = model.score([text])[0]
    assert abs(alone + one * math.log10(2)) < 1e-6
    assert np.allclose(model.score([b"", text, b"x" * 999, text, b""])[[1, 3]], alone, rtol=1e-12)
    assert model.score([]).shape == (0,)


def test_weights_learn_whom_to_trust(model):
    """Where all contexts are known the long ones count more than the shortest; refinement stays a probability."""
    mixer = lm.Mixer(model.state)
    known = mixer.weights[len(lm.ORDERS) * 8 :]
    assert known[:, 2:].sum(1).mean() > 2 * known[:, 0].mean()
    assert ((mixer.refined > 0) & (mixer.refined < 1)).all()


def test_tasks_add_up(spark):
    """Context counts don't depend on how the texts lie; held-out texts leave no trace."""
    texts = [(i, f"some text number {i} with words and words") for i in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    one, many = lm.train(frame.coalesce(1)), lm.train(frame.repartition(5))
    assert (one.votes == many.votes).all()
    learned = [t.encode() for _, t in texts]
    learner = lm.Learner(one.bits)
    learner.block(learned)
    c = learner.counts
    assert (one.votes == np.log((c[:, 1] + lm.PRIOR) / (c[:, 0] + lm.PRIOR)).astype(np.float16)).all()
    held = [i for i, _ in texts if out_of_sample(i)]
    changed = spark.createDataFrame([(i, "zzz qqq" if i in held else t) for i, t in texts], "doc_id long, text string")
    a = {r.doc_id: r.score for r in lm.score(frame).collect()}
    b = {r.doc_id: r.score for r in lm.score(changed).collect()}
    assert held and all((a[i] == b[i]) == (i not in held) for i, _ in texts)


def test_learned_text_scores_above_noise(spark, model):
    texts = [r.text for r in documents(spark, SMALL).collect() if r.text and len(r.text) > 300]
    noise = bytes(np.random.default_rng(1).integers(97, 123, 300, dtype=np.uint8))
    assert all(s / len(t) > model.score([noise])[0] / 300 for s, t in zip(model.score([t[:300].encode() for t in texts]), [t[:300] for t in texts]))


def test_no_rows_and_clashing_names(docs):
    assert lm.score(docs([])).count() == 0
    frame = docs(["a", "b"]).withColumnRenamed("k", "shard").withColumnRenamed("n", "score").withColumnRenamed("id", "counts")
    out = lm.score(frame)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "counts", "shard", *lm.NEW]
    assert [(r.shard, r.counts) for r in out.collect()] == [(7, "y")] * 2
    none = lm.score(docs([(16, "held out only")]).where("doc_id = 16")) if out_of_sample(16) else None
    if none is not None:
        r = none.first()
        assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and abs(r.bits_per_byte - 8) < 1e-6


def peak(run):
    """MB that numpy and Python hold at once while ``run`` runs, beyond what they held before."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task(monkeypatch):
    rng = np.random.default_rng(1)
    some = ["".join(map(chr, w)) for w in rng.integers(97, 123, (3000, 6))]
    texts = [" ".join(some[i] for i in rng.integers(0, 3000, 400)) for _ in range(2400)]
    learner = lm.Learner(lm.MOST_BITS)
    learner.block([t.encode() for t in texts[:50]])
    assert peak(lambda: [len(d) for _, d in learner.parts()]) < 40  # a copy of all counts before: 84
    votes = np.log((learner.counts[:, 1] + lm.PRIOR) / (learner.counts[:, 0] + lm.PRIOR)).astype(np.float16)
    shared = SimpleNamespace(value=lm.Model(lm.MOST_BITS, votes, learner.mixer.state.copy()))
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([False] * len(texts)), pa.array(texts)], names=["c0", "h", "t"])
    out = []
    assert peak(lambda: out.extend(lm._sharded(shared, 1, lm.SHARD)(iter([batch])))) < 220  # 6 MB at once and a wider copy of the model before: 389
    assert sum(map(len, texts)) > 6 << 20 and sum(b.num_rows for b in out) == 1 and len(out[0]["scores"][0].as_py()) == 8 * len(texts)


def sample(n, size=400):
    rng = np.random.default_rng(2)
    some = [bytes(rng.integers(97, 123, k, dtype=np.uint8)) for k in rng.integers(2, 9, 3000)]
    return [b" ".join(some[i] for i in rng.integers(0, 3000, size)) for _ in range(n)]


def test_memory_of_a_learned_block():
    texts = sample(2800)
    assert sum(map(len, texts)) > lm.BLOCK
    learner = lm.Learner(lm.MOST_BITS)
    assert peak(lambda: learner.block(texts)) < 150  # all places and the slots of all steps at once before: 239


def test_parts_change_nothing(monkeypatch):
    """Places are counted, predicted and added up a part at a time: to the last bit the same."""
    texts = [b"", *sample(40, 60), b"x" * 3000, b"", b"the end"]

    def run(part):
        monkeypatch.setattr(lm, "_PART", part)
        learner = lm.Learner(12)
        learner.block(texts[:20])
        learner.block(texts[20:])
        votes = np.log((learner.counts[:, 1] + lm.PRIOR) / (learner.counts[:, 0] + lm.PRIOR)).astype(np.float16)
        model, held = lm.Model(12, votes, learner.mixer.state.copy()), [i % 3 == 0 for i in range(len(texts))]
        shard, scores = lm._Shard(0), model.score(texts)
        shard.add([pa.array([{"c0": i} for i in range(len(texts))])], held, texts, scores)
        row = shard.row()
        counts = lm._unplaned(row[-1][0].as_py()).astype(np.int64)
        batch = pa.RecordBatch.from_arrays([row[0], *row[2:8], pa.array([[{"bin": 0, "counts": counts.tobytes()}]])], names=[*"abcdefgh"])
        out = list(lm._finished(9000, 3000, 30, 1, ["doc_id", *lm.NEW])(iter([batch])))
        learned = Counter(w for t, h in zip(texts, held) if not h for w in lm.tokens(t))
        assert out[0]["n_known"].to_pylist() == [1 + sum(learned[w] > 0 for w in lm.tokens(t)) for t in texts]
        return learner.counts, learner.mixer.state, scores, *(np.array(c) for b in out for c in b.columns)

    whole, parts = run(1 << 20), run(50)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def test_one_key_after_another():
    """Steps go by what the sorted keys share."""
    keys = np.array([5 << 8 | 3, 5 << 8 | 131, 6 << 8, 6 << 8 | 1], np.uint64)
    parted = lm._parted(keys)
    assert parted.tolist() == [256, 128, 256, 1]
    firsts = [[(first.tolist(), some.tolist(), bit.tolist()) for _, first, some, bit in lm._steps(keys, parted, j)] for j in (0, 1, 7)]
    assert firsts[0] == [([0, 2], [5, 6], [False, True, False, False])]
    assert firsts[1] == [([0, 1, 2], [10, 11, 12], [False, False, False, False])]
    assert firsts[2] == [([0, 1, 2], [5 << 7 | 1, 5 << 7 | 65, 6 << 7], [True, True, False, True])]


def test_a_task_gives_free_memory_back(monkeypatch):
    """Before it begins, and before it hands out what it gathered; also where the C library has no such call."""
    calls = []
    monkeypatch.setattr(lm.ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=calls.append))
    batch = pa.RecordBatch.from_arrays([pa.array(["some text", None])], names=["t"])
    some = [b.to_pydict() for b in lm._learned(lm.LEAST_BITS)(iter([batch]))]
    assert calls == [0, 0]
    monkeypatch.setattr(lm.ctypes, "CDLL", lambda name: SimpleNamespace())
    assert some == [b.to_pydict() for b in lm._learned(lm.LEAST_BITS)(iter([batch]))]
